"""Page corpora as crawlers leave them: one file a page, each in a character set of its own."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martkit.session import scratch_path

# The character set a browser takes for a declared name, by what Java calls it.
CHARSETS = {
    "UTF-8": ("utf-8", "utf8", "unicode-1-1-utf-8", "utf-16", "utf-16le", "utf-16be"),
    "windows-1252": ("windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "l1", "ascii",
                     "us-ascii"),
    "windows-1250": ("windows-1250", "cp1250"),
    "windows-1251": ("windows-1251", "cp1251"),
    "windows-1253": ("windows-1253", "cp1253"),
    "windows-1254": ("windows-1254", "cp1254", "iso-8859-9", "latin5"),
    "windows-1257": ("windows-1257", "cp1257"),
    "ISO-8859-2": ("iso-8859-2", "latin2"),
    "ISO-8859-5": ("iso-8859-5",),
    "ISO-8859-7": ("iso-8859-7", "greek"),
    "ISO-8859-15": ("iso-8859-15", "latin9"),
    "KOI8-R": ("koi8-r", "koi8", "koi"),
    "KOI8-U": ("koi8-u",),
    "GB18030": ("gb18030", "gbk", "gb2312", "chinese", "x-gbk"),
    "Big5": ("big5", "big5-hkscs", "cn-big5"),
    "windows-31j": ("shift_jis", "shift-jis", "sjis", "x-sjis", "windows-31j"),
    "EUC-JP": ("euc-jp", "x-euc-jp"),
    "x-windows-949": ("euc-kr", "ks_c_5601-1987", "korean", "windows-949"),
}
# Byte order marks.
MARKS = {"EFBBBF": "UTF-8", "FEFF": "UTF-16BE", "FFFE": "UTF-16LE"}
# Fixed value: a declaration is looked for in so many first bytes.
PRESCAN = 1024
_DECLARED = r"""(?is)<meta\s[^>]*?charset\s*=\s*["']?\s*([^\s"'/>;]+)"""
#: Files that are listed at once: a list of files is in the driver's memory, with some kilobytes for each.
FILES_AT_ONCE = 20_000
#: While portions are read: tasks that list folders, where Spark takes one for each folder up to 10,000, and bytes that opening
#: a file counts for, where 4 MB make a task of a few files and the driver remembers every task.
_PORTION_SETTINGS = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": 200, "spark.sql.files.openCostInBytes": 64 << 10}
_SETTINGS = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")


@contextmanager
def _any_charset(spark: SparkSession) -> Iterator[None]:
    """``decode`` takes these two settings up when it is planned: every character set of the
    JVM, and U+FFFD for bytes that mean nothing, where it would otherwise end the job."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k in _SETTINGS:
        spark.conf.set(k, "true")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def charset_of(content: Column) -> Column:
    """The character set of a page: its byte order mark, what it declares, or what its bytes allow.

    A page that declares none, or one that is not known, is UTF-8 where its bytes are valid
    and windows-1252 otherwise.
    """
    first = F.hex(F.substring(content, 1, 3))
    marked = F.coalesce(*[F.when(first.startswith(mark), F.lit(name)) for mark, name in MARKS.items()])
    head = F.decode(F.substring(content, 1, PRESCAN), "ISO-8859-1")
    label = F.lower(F.regexp_extract(head, _DECLARED, 1))
    names = F.create_map(*[F.lit(x) for java, labels in CHARSETS.items() for n in labels for x in (n, java)])
    guessed = F.when(F.is_valid_utf8(content.cast("string")), F.lit("UTF-8")).otherwise(F.lit("windows-1252"))
    return F.coalesce(marked, F.try_element_at(names, label), guessed)


def decode_pages(files: DataFrame, content: str = "content", html: str = "html") -> DataFrame:
    """``content`` (bytes) as ``html`` (text), without its byte order mark; NULL stays NULL, no bytes are an empty text."""
    staged = files.withColumn("_charset", charset_of(F.col(content)))
    with _any_charset(files.sparkSession):
        text = staged.withColumn(html, F.call_function("decode", F.col(content), F.col("_charset")))
    return text.withColumn(html, F.regexp_replace(html, "^\ufeff", "")).drop("_charset", content)


@contextmanager
def _few_tasks(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in _PORTION_SETTINGS}
    for k, v in _PORTION_SETTINGS.items():
        if not before[k].isdigit() or int(before[k]) > v:
            spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _is_hidden(name: str) -> bool:
    """What Spark's file sources pass over."""
    return (name.startswith((".", "_")) and not (name.startswith("_") and "=" in name) or name.endswith("._COPYING_")) \
        and not name.startswith(("_common_metadata", "_metadata"))


def _portions(files, folder) -> Iterator[list[str]]:
    """What lies in a folder, in lists of paths with FILES_AT_ONCE files below them at most.

    A folder with more is entered; names are taken from the listing one by one.
    """
    paths, n = [], 0
    entries = files.listStatusIterator(folder)
    while entries.hasNext():
        entry = entries.next()
        path = entry.getPath()
        if _is_hidden(path.getName()):
            continue
        own = files.getContentSummary(path).getFileCount() if entry.isDirectory() else 1
        if entry.isDirectory() and own > FILES_AT_ONCE:
            yield from _portions(files, path)
            continue
        if paths and n + own > FILES_AT_ONCE:
            yield paths
            paths, n = [], 0
        # Characters that have a meaning in a pattern of paths stand for themselves here.
        paths.append(re.sub(r"([\\{}\[\]*?])", r"\\\1", path.toString()))
        n += own
    if paths:
        yield paths


def read_raw_pages(spark: SparkSession, path: str, site: str = "", pattern: str = "*",
                   tasks: int | None = None) -> DataFrame:
    """The files below ``path`` as (page_id, url, html), one row a file.

    ``url`` is ``site`` followed by the file's path below ``path``.  ``page_id`` is that of
    folders named page_id=..., where there are such, and else a hash of the url.  Bytes are
    decoded in the JVM.  Files without a byte are left out, as by all of Spark's file sources.  Spark packs files into tasks by size, so many small ones are few
    tasks; ``tasks`` deals the decoded pages out where reading them costs more than that.

    Where there are more than FILES_AT_ONCE files, they are listed, read and stored in the scratch folder
    in portions of so many, as the driver holds the list of all files of a table.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    storage = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    root = storage.makeQualified(hadoop).toString().rstrip("/") + "/"

    def read(paths: list[str]) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths)
        below = F.substr(F.col("path"), F.lit(len(root) + 1))
        folder = F.regexp_extract(below, r"(?:^|/)page_id=([0-9]+)/", 1)
        url = F.concat(F.lit(site), below)
        return decode_pages(files.select(
            F.coalesce(F.try_to_number(F.nullif(folder, F.lit("")), F.lit("9" * 19)).cast("long"), F.xxhash64(url)).alias("page_id"),
            url.alias("url"), "content"))
    # A pattern of paths is left to Spark, as are folders where all is hidden.
    stored = None
    if storage.exists(hadoop) and storage.getContentSummary(hadoop).getFileCount() > FILES_AT_ONCE:
        with _few_tasks(spark):
            for paths in _portions(storage, hadoop):
                stored = stored or scratch_path(spark, "decoded-pages")
                read(paths).write.mode("append").parquet(stored)
    pages = spark.read.schema("page_id long, url string, html string").parquet(stored) if stored else read([path])
    return pages.repartition(tasks) if tasks else pages
