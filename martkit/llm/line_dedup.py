"""Line dedup by a segment-partition edit join, in column expressions alone.

Two lines within ``threshold`` edits of each other agree in one of ``threshold + 1`` segments of
the shorter one, near the place where it stands there.  Every line is indexed by its segments
and probes those of lines of its own length and up to ``threshold`` less, at the few places that
the edits left and right of a segment allow.  What meets on a segment is checked by the edit distance
in a band of the distance table.  Lines with a segment that very many share meet on more of their text.

Equal lines are one: they are counted first by a partial aggregate, and lines with many copies
enter the join once.  Lines that links join, directly or over others, are a class; the first
line of a class (smallest document, then smallest number) stays and its other lines go.

Lines of ``min_chars`` characters or more are compared with ``threshold`` edits.  With ``short``
every other line that is not empty takes part too: lines of ONE_EDIT_CHARS characters or more with
one edit (the shorter line of a pair says how many), and below that copies alone go.  Without it
shorter lines stay.  Empty lines and texts stay; null texts have no lines.  Null ids come before all others.  Rows that agree in id
and text are one document: equal rows get equal results.  Documents that share an id alone, or have none, are
documents of their own, in the order of a hash of their texts.  Other columns are kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.base import stored
from martkit.llm.components import components

THRESHOLD = 2
MIN_CHARS = 24
#: Lines of fewer than ``min_chars`` but so many characters are compared with one edit, as two would join unlike words.
ONE_EDIT_CHARS = 12
#: Lines with more copies enter the join once; others as often as they occur.
COPIES = 20
# The letters whose counts are compared.
LETTERS = ["etaoin", "shrdlu"]
#: Lines that share a segment; where there are more, they meet on all but two of so many pieces of the line.
HOT, PIECES = 24, 8
#: Rows up to which a table of hashes is sent to the tasks; a larger one is joined by shuffle.
SENT_ROWS = 200_000
#: Where a line stands: in which document, and at which number.
PLACE = ["doc_id", "th", "pos"]


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """Their document (doc_id and text hash), pos (from 0), line and its hash, for lines that are long enough."""
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.filter(F.length("line") >= min_chars).select(
        "doc_id", "th", "pos", "line", F.xxhash64("line").alias("h"))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def letter_counts(line: Column, letters: str) -> Column:
    """How often each of six letters occurs, 1,023 at most, in ten bits each of one number."""
    out = F.lit(0).cast("bigint")
    for i, c in enumerate(letters):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
        out = out + F.shiftleft(F.least(n, F.lit(1023)).cast("bigint"), 10 * i)
    return out


def counts_apart(a: Column, b: Column) -> Column:
    """By how much the counts of two lines differ in all; an edit changes two by one at most."""
    return sum((F.abs(F.shiftright(a, 10 * i).bitwiseAND(1023) - F.shiftright(b, 10 * i).bitwiseAND(1023))
                for i in range(6)), F.lit(0))


def _sent(table: DataFrame) -> DataFrame:
    """A finished table, marked to be sent to all tasks if it is small enough."""
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def _piece(length: Column, parts: int, i: Column) -> tuple[Column, Column]:
    """(start, size) of piece ``i`` of a line: all of one size, the last ones a character longer."""
    size, short = F.floor(length / parts).cast("int"), parts - length % parts
    start = size * i + F.greatest(F.lit(0), i - short) + 1
    return start.cast("int"), (size + (i >= short).cast("int")).cast("int")


def _places(threshold: int) -> list[tuple[int, int, int]]:
    """(less, i, shift): where segment i of a line shorter by ``less`` can stand in a line.

    With segment i (from 0) unchanged, at most i edits are left of it and at most threshold - i
    right of it; both bound how far it is shifted.  Of two lines of one length each looks for the other: with two
    edits, a segment that one sees moved left is seen moved right by the other.
    """
    return [(less, i, shift) for less in range(threshold + 1) for i in range(threshold + 1)
            for shift in range(max(-i, less - (threshold - i)), min(i, less + (threshold - i)) + 1)
            if not (threshold == 2 and less == 0 and shift < 0)]


def _each(rows: DataFrame, names: str, values: list[tuple]) -> DataFrame:
    """Every row once with each of the values: one expression serves them all, instead of one for each."""
    return rows.select("*", F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names.split(), x)])
                                               for x in values])))


def _segment(threshold: int, length: Column, shift: Column) -> Column:
    """The key of segment ``i`` of lines of some length, as it stands in a line, moved by ``shift``."""
    start, size = _piece(length, threshold + 1, F.col("i"))
    return F.xxhash64("i", length, F.substring("line", start + shift, size)).alias("key")


def index_keys(rows: DataFrame, threshold: int, *more: str) -> DataFrame:
    """(key, h) and more columns: the segments of every line (h, line, size)."""
    return _each(rows, "i", [(i,) for i in range(threshold + 1)]).select(
        _segment(threshold, F.col("size"), F.lit(0)), "h", *more)


def probe_keys(rows: DataFrame, threshold: int) -> DataFrame:
    """(key, other): segments of lines shorter by 0 to ``threshold``, at the places where they can stand in a line."""
    return _each(rows, "less i shift", _places(threshold)).select(
        _segment(threshold, F.col("size") - F.col("less"), F.col("shift")), F.col("h").alias("other"))


def held_lines(rows: DataFrame, hot: DataFrame, threshold: int) -> DataFrame:
    """(h, line, size, indexed): lines that hold a segment of ``hot`` (key, i, size), as their own one (indexed) or moved.

    Only lines of a length in which such a segment can stand are looked at, and only at its places.
    """
    places = [(0, None, 0, True), *[(*x, False) for x in _places(threshold)]]
    kinds = _each(hot.select("i", F.col("size").alias("length")).distinct(), "less its_i shift indexed", places).filter(
        F.col("its_i").isNull() | (F.col("its_i") == F.col("i"))).select(
        (F.col("length") + F.col("less")).alias("size"), "i", "length", "shift", "indexed")
    looked = rows.join(_sent(stored(kinds, "lines-kinds")), "size").select(
        _segment(threshold, F.col("length"), F.col("shift")), "h", "line", "size", "indexed")
    return looked.join(_sent(hot.select("key")), "key", "left_semi").groupBy("h").agg(
        F.first("line").alias("line"), F.first("size").alias("size"), F.max("indexed").alias("indexed"))


def _around(length: Column, between: Column, less: Column) -> Column:
    """Hash of a line without its pieces p and q (of PIECES): before p, between them (moved), behind q (moved by ``less``)."""
    p, q = F.col("p"), F.col("q")
    (at_p, size_p), (at_q, size_q) = _piece(length, PIECES, p), _piece(length, PIECES, q)
    behind = at_q + size_q
    return F.xxhash64(p, q, length, F.substring("line", F.lit(1), at_p - 1), F.substring(
        "line", at_p + size_p + between, at_q - at_p - size_p), F.substring("line", behind + less, length - behind + 1))


def _left_out(length: Column, between: Column, less: Column) -> Column:
    """The pieces p and q that ``_around`` leaves out, one behind the other, as the line has them."""
    (at_p, size_p), (at_q, size_q) = _piece(length, PIECES, F.col("p")), _piece(length, PIECES, F.col("q"))
    return F.concat(F.substring("line", at_p, size_p + between), F.substring("line", at_q + between, size_q + less - between))


def long_index_keys(rows: DataFrame, *more: str) -> DataFrame:
    """(key, h, out) and more columns: all but two of the PIECES pieces of every line, and those two."""
    pieces = [(p, q) for q in range(PIECES) for p in range(q)]
    around = F.col("size"), F.lit(0), F.lit(0)
    return _each(rows, "p q", pieces).select(_around(*around).alias("key"), "h", _left_out(*around).alias("out"), *more)


def long_probe_keys(rows: DataFrame, *more: str) -> DataFrame:
    """(key, other, its_out) and more columns: those of lines shorter by 0 to 2, as two edits in the two pieces left out may move them."""
    pieces = [(p, q, less, between) for q in range(PIECES) for p in range(q) for less in range(3)
              for between in ([0] if q == p + 1 else range(max(-1, less - 1), 2))]
    around = F.col("size") - F.col("less"), F.col("between"), F.col("less")
    return _each(rows, "p q less between", pieces).select(
        _around(*around).alias("key"), F.col("h").alias("other"), _left_out(*around).alias("its_out"), *more)


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance of two strings is ``threshold`` at most; only a band of the distance table is filled."""
    return F.levenshtein(a, b, threshold) >= 0


def _pairs(met: DataFrame) -> DataFrame:
    return met.filter(F.col("h") != F.col("other")).select(
        F.least("h", "other").alias("a"), F.greatest("h", "other").alias("b")).distinct()


def lines_once(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """(h, line, size), lines with many copies as their first place has them."""
    many = counts.filter(F.col("n") > COPIES).select("h", F.col("first").alias("kept"))
    return lines.join(_sent(many), "h", "left").filter(
        F.col("kept").isNull() | F.col("kept").eqNullSafe(F.struct(*PLACE))).select("h", "line", F.length("line").alias("size"))


def line_links(lines: DataFrame, counts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) of hashes of different lines that join all lines within the threshold, directly or over others.

    A segment that more than HOT lines share, as in a large group of near copies or under a common
    beginning, would meet in pairs that are hardly ever near.  Lines that have one meet on all but two of PIECES
    pieces instead, which holds for every pair within two edits; each is compared with the first line it meets, and
    then with lines that this has not joined with it, if the counts of some letters allow two edits.  Both are
    decided where lines meet, by the two pieces that each has besides.
    """
    rows = lines_once(lines, counts)
    index, probe = index_keys(rows, threshold), probe_keys(rows, threshold)
    hot = None
    if threshold == 2:
        # Equal keys are of one segment and length.
        hot = stored(index_keys(rows, threshold, "i", "size").groupBy("key").agg(
            F.count("*").alias("n"), F.max("i").alias("i"), F.max("size").alias("size")).filter(F.col("n") > HOT).drop("n"), "lines-hot")
    if hot is None or hot.isEmpty():
        return near_links(lines, stored(_pairs(index.join(probe, "key")), "lines-pairs"), threshold)
    held = stored(held_lines(rows, hot, threshold), "lines-held")
    hot = _sent(hot.select("key"))
    # Lines without such a segment, and the other segments of those that have one.
    rest = rows.join(_sent(held.filter("indexed").select("h")), "h", "left_anti")
    cold = index_keys(rest, threshold).unionByName(
        index_keys(held.filter("indexed"), threshold).join(hot, "key", "left_anti"))
    links = near_links(lines, stored(_pairs(cold.join(probe, "key")), "lines-pairs"), threshold)
    firsts = long_index_keys(held.filter("indexed")).groupBy("key").agg(F.min(F.struct("h", "out")).alias("first")).select(
        "key", "first.*")
    # Two lines that agree beside two pieces are apart by what these are apart, so only near ones come out as pairs.
    near = within(F.col("out"), F.col("its_out"), threshold)
    star = stored(near_links(lines, stored(_pairs(long_probe_keys(held).join(firsts, "key").filter(near)), "lines-stars"),
                             threshold), "lines-links")
    known = stored(held.join(components(star), F.col("h") == F.col("member"), "left").select(
        "h", "line", "size", "indexed", F.coalesce("root", "h").alias("root"),
        *[letter_counts(F.col("line"), x).alias(x) for x in LETTERS]), "lines-roots")
    one = long_index_keys(known.filter("indexed"), "root", *LETTERS)
    two = long_probe_keys(known.withColumnsRenamed({x: f"their_{x}" for x in ("root", *LETTERS)}),
                          "their_root", *[f"their_{x}" for x in LETTERS])
    # Only where a key has lines of different classes are there pairs left to look at.
    rest = one.join(two, (one["key"] == two["key"]) & (F.col("root") != F.col("their_root")) & (
        sum((counts_apart(F.col(x), F.col(f"their_{x}")) for x in LETTERS), F.lit(0)) <= 2 * threshold) & near)
    return links.unionByName(star).unionByName(
        near_links(lines, stored(_pairs(rest), "lines-pairs"), threshold))


def near_links(lines: DataFrame, pairs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs whose lines are within the threshold."""
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "lines-ends")
    wanted = stored(lines.select("h", "line").join(_sent(ends), "h", "left_semi").groupBy("h").agg(
        F.min("line").alias("line")), "lines-wanted")
    both = pairs.join(wanted.select(F.col("h").alias("a"), F.col("line").alias("one")), "a").join(
        wanted.select(F.col("h").alias("b"), F.col("line").alias("two")), "b")
    shorter = F.length("one") <= F.length("two")
    ordered = both.select("a", "b", F.when(shorter, F.col("one")).otherwise(F.col("two")).alias("one"),
                          F.when(shorter, F.col("two")).otherwise(F.col("one")).alias("two"))
    return ordered.filter((F.length("two") - F.length("one") <= threshold) &
                          within(F.col("one"), F.col("two"), threshold)).select("a", "b")


def short_links(lines: DataFrame, low: int, high: int) -> DataFrame:
    """Links (a, b) that join lines within one edit whose shorter one has ``low`` to ``high`` - 1 characters.

    Lines that agree without the character at one place are linked to the first of them, and a line
    to every line that it becomes without one character: no pairs are formed, whatever the groups.
    """
    rows = stored(lines.filter(F.length("line").between(low, high)).select("h", "line").distinct(), "lines-short")
    line, shorter = F.col("line"), rows.filter(F.length("line") < high)

    def without(i: Column) -> Column:
        return F.concat(F.substring(line, F.lit(1), i - 1), F.substring(line, i + 1, F.length(line)))
    places = F.sequence(F.lit(1), F.length(line))
    keys = shorter.select("h", F.explode(F.transform(places, lambda i: F.xxhash64(i, without(i)))).alias("key"))
    groups = stored(keys.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("last")).filter("a < last")
                    .select("key", "a"), "lines-replaced")
    replaced = keys.join(_sent(groups), "key").filter("h <> a").select("a", F.col("h").alias("b"))
    dropped = rows.filter(F.length("line") > low).select(F.col("h").alias("b"), F.explode(
        F.array_distinct(F.transform(places, lambda i: F.xxhash64(without(i))))).alias("a"))
    dropped = dropped.join(_sent(stored(shorter.select(F.col("h").alias("a")), "lines-shorter")), "a")
    return replaced.unionByName(dropped.select("a", "b")).distinct()


def repeated_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS,
                   short: bool = False) -> DataFrame:
    """Document and pos of every line that is not the first one of its class, with its class."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = lines_of(rows, 1 if short else min_chars)
    compared = lines.filter(F.length("line") >= min_chars)
    occurrences = stored(lines.select(*PLACE, "h"), "lines-occurrences")
    counts = stored(occurrences.groupBy("h").agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n")), "lines-counts")
    links = line_links(compared, counts, threshold)
    if short and threshold > 0:
        links = links.unionByName(short_links(lines, ONE_EDIT_CHARS, min_chars))
    links = stored(links, "lines-links")
    roots = stored(components(links), "lines-classes")
    classes = counts.join(roots, F.col("h") == F.col("member"), "left").select(
        "h", "first", "n", F.coalesce("root", "h").alias("class_id"), F.col("root").isNotNull().alias("linked"))
    firsts = classes.filter("linked").groupBy("class_id").agg(F.min("first").alias("class_first"))
    known = classes.filter((F.col("n") > 1) | F.col("linked")).join(firsts, "class_id", "left").select(
        "h", "class_id", F.coalesce("class_first", "first").alias("class_first"))
    return occurrences.join(_sent(stored(known, "lines-known")), "h").filter(
        ~F.struct(*PLACE).eqNullSafe(F.col("class_first"))).select(*PLACE, "class_id")


def _removed(docs: DataFrame, threshold: int, min_chars: int, short: bool) -> DataFrame:
    gone = repeated_lines(docs, threshold, min_chars, short)
    return gone.groupBy(F.col("doc_id").alias("its_doc"), F.col("th").alias("its_th")).agg(
        F.array_sort(F.collect_set("pos")).alias("removed"))


def _beside(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The removed lines beside the rows (doc_id, th) of their documents."""
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["its_doc"]) & (rows["th"] == gone["its_th"]), "left")


def line_report(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS,
                short: bool = False) -> DataFrame:
    """Per document: its lines, how many of them are removed, and the numbers (from 0) of those."""
    gone = _removed(docs, threshold, min_chars, short)
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("th"), F.when(F.col("text").isNull() | (F.col("text") == ""), F.lit(0)).otherwise(
        F.size(F.split("text", "\n"))).cast("bigint").alias("n_lines"))
    return _beside(rows, gone).select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"))


def drop_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS,
               short: bool = False) -> DataFrame:
    """``docs`` without the repeated lines; all columns kept in place."""
    gone = _removed(docs, threshold, min_chars, short)
    rows = docs.select(F.struct("*").alias("row")).select("row", "row.doc_id", text_hash(F.col("row.text")).alias("th"))
    kept = F.array_join(F.filter(F.split("row.text", "\n"), lambda line, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(kept)
    return _beside(rows, gone).select(
        [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
