"""Raw page files, more of them than are listed at once."""

from martkit.sources import rawpages
from martkit.sources.rawpages import read_raw_pages


def _tree(root):
    """Pages in folders of several depths, with names that are patterns, and files that are no pages."""
    names = [*[f"shelf={i % 3}/page_id={i}/part-0.html" for i in range(11)], "a[1].html", "b{2}/c*.html", "d?/e f.html", "g%20h.html",
             *[f"flat/{i}.html" for i in range(7)], "deep/er/still/x.html"]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(f"<p>{name}".encode())
    for name in ("_SUCCESS", ".hidden.html", "_tmp/y.html", "notes.txt", "flat/empty.html", "flat/.z.html"):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(b"" if "empty" in name else b"no page")
    return names


def test_portions_hold_every_file_once(spark, tmp_path, monkeypatch):
    names = _tree(tmp_path)
    whole = {tuple(r) for r in read_raw_pages(spark, str(tmp_path), "http://a/", "*.html").collect()}
    assert len(whole) == len(names)
    listed, load = [], type(spark.read).load
    monkeypatch.setattr(rawpages, "FILES_AT_ONCE", 5)

    def counted(self, paths, *more, **options):
        out = load(self, paths, *more, **options)
        listed.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(type(spark.read), "load", counted)
    before = {k: spark.conf.get(k) for k in rawpages._PORTION_SETTINGS}
    pages = read_raw_pages(spark, str(tmp_path), "http://a/", "*.html")
    rows = [tuple(r) for r in pages.collect()]
    assert len(rows) == len(names) and set(rows) == whole
    # The driver never holds the list of more files than that.
    assert max(listed) <= 5 and sum(listed) >= len(names)
    assert {k: spark.conf.get(k) for k in rawpages._PORTION_SETTINGS} == before
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_nothing_to_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rawpages, "FILES_AT_ONCE", 1)
    for name in ("_x", "_y", ".z"):
        (tmp_path / name).write_bytes(b"no page")
    assert read_raw_pages(spark, str(tmp_path)).count() == 0
    (tmp_path / "page_id=3").mkdir()
    (tmp_path / "page_id=3" / "x").write_bytes(b"")
    assert read_raw_pages(spark, str(tmp_path)).count() == 0


def test_pages_are_written_and_read_in_portions(spark, tmp_path, monkeypatch):
    from catalog import pages as catalog_pages

    rows = [(i, f"http://a/{i}", f"<html><body><h1>Page {i} é</h1></body></html>") for i in range(30)]
    frame = spark.createDataFrame([*rows, (None, "http://a/", "<h1>none</h1>")], "page_id long, url string, html string")
    frame.coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    want = {tuple(r) for r in catalog_pages.raw_pages(spark, str(tmp_path)).collect() if r.heading != "none"}
    assert len(want) == 30
    monkeypatch.setattr(catalog_pages, "_PAGES_A_JOB", 7)
    monkeypatch.setattr(rawpages, "FILES_AT_ONCE", 10)
    folder = catalog_pages.raw_folder(spark, str(tmp_path))
    import os
    ids = [[d for _, dirs, _ in os.walk(f"{folder.removeprefix('file:')}/{x}") for d in dirs if d.startswith("page_id=")] for x in os.listdir(folder)]
    assert len(ids) == 5 and sum(map(len, ids)) == 31 and max(map(len, ids)) < 20
    got = [tuple(r) for r in catalog_pages.raw_pages(spark, str(tmp_path)).collect()]
    assert len(got) == 31 and want <= set(got)
