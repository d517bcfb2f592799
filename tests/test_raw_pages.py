"""Raw page files: byte order marks, declared and undeclared character sets, broken bytes."""

import codecs

import pytest

from martkit.sources.rawpages import decode_pages, read_raw_pages

META = '<meta charset="{}"><p>{}</p>'
FILES = {
    "plain.html": ("<p>café</p>".encode(), "<p>café</p>"),
    "marked.html": (codecs.BOM_UTF8 + b"<p>x</p>", "<p>x</p>"),
    "wide/le.html": (codecs.BOM_UTF16_LE + "<p>日</p>".encode("utf-16-le"), "<p>日</p>"),
    "wide/be.html": (codecs.BOM_UTF16_BE + "<p>日</p>".encode("utf-16-be"), "<p>日</p>"),
    # A mark goes before a declaration; a declared UTF-16 in a page that can be read as ASCII is UTF-8.
    "both.html": (codecs.BOM_UTF8 + META.format("koi8-r", "Ж").encode(), META.format("koi8-r", "Ж")),
    "odd.html": (META.format("utf-16", "Ж").encode(), META.format("utf-16", "Ж")),
    "latin.html": (META.format("ISO-8859-1", "5 € “x”").encode("cp1252"), META.format("ISO-8859-1", "5 € “x”")),
    "undeclared.html": ("<p>naïve</p>".encode("cp1252"), "<p>naïve</p>"),
    "unknown.html": (META.format("martian", "Ж").encode(), META.format("martian", "Ж")),
    "broken.html": (META.format("utf-8", "a").encode() + b"\xff.", META.format("utf-8", "a") + "�."),
}
for _label, _codec, _text in [("koi8-r", "koi8-r", "Жук"), ("windows-1251", "cp1251", "Жук"), ("Shift_JIS", "cp932", "日本"),
                              ("euc-kr", "cp949", "한국"), ("gb2312", "gb18030", "漢字"), ("big5", "big5", "漢字")]:
    _page = f'<META http-equiv=Content-Type content="text/html; charset={_label}">{_text}'
    FILES[f"{_label}.html"] = (_page.encode(_codec), _page)


def test_files_of_many_character_sets(spark, tmp_path):
    for name, (content, _) in FILES.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    (tmp_path / "notes.txt").write_bytes(b"no page")
    (tmp_path / "empty.html").write_bytes(b"")
    pages = read_raw_pages(spark, str(tmp_path), "http://a.example/", "*.html")
    assert pages.columns == ["page_id", "url", "html"]
    rows = pages.collect()
    assert {r.url.removeprefix("http://a.example/"): r.html for r in rows} == {n: t for n, (_, t) in FILES.items()}
    assert len({r.page_id for r in rows}) == len(FILES)
    # The settings that decoding is planned with are the session's own again.
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_ids_of_folders(spark, tmp_path):
    for n in (7, 12):
        (tmp_path / f"page_id={n}").mkdir()
        (tmp_path / f"page_id={n}" / "part-0.txt").write_bytes(b"<p>")
    assert {r.page_id for r in read_raw_pages(spark, str(tmp_path)).collect()} == {7, 12}


@pytest.mark.parametrize("content", [None, bytearray(b"")])
def test_no_bytes(spark, content):
    frame = spark.createDataFrame([(1, content)], "page_id int, content binary")
    assert decode_pages(frame).collect()[0].html == (None if content is None else "")
    assert decode_pages(frame.limit(0)).count() == 0
