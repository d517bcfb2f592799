"""Column functions against hand-built values."""

from datetime import datetime
from urllib.parse import urljoin
import html as stdlib_html

import pytest
from pyspark.sql import functions as F

from martkit.functions import html as H
from martkit.functions import numbers as N
from martkit.functions import text as X
from martkit.functions import urls as U
from martkit.functions.availability import (
    STATUS_RULES, first_pattern_int, with_availability)


def values(spark, inputs, make, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


STOCK = [
    ("In stock (22 available)", 22, 22, "in_stock", "In stock", "in_stock"),
    ("In stock", 0, 1, "in_stock", "In stock", "in_stock"),
    ("Out of stock", 0, 0, "out_of_stock", "Out of stock", "out_of_stock"),
    ("Out of stock (5 available)", 5, 0, "out_of_stock", "Out of stock", "out_of_stock"),
    ("(22 available)", 22, 22, "in_stock", "In stock (22 available)", "in_stock"),
    ("(available)", 0, 1, "in_stock", "In stock (1 available)", "in_stock"),
    ("not available", 0, 0, "out_of_stock", "not available", "unknown"),
    ("5000 available", 0, 1, "in_stock", "5000 available", "unknown"),
    ("12 left", 12, 12, "in_stock", "12 left", "unknown"),
    ("Pre-order", 0, 0, "out_of_stock", "Pre-order", "unknown"),
    ("2024 model, 3 left", 3, 3, "in_stock", "2024 model, 3 left", "unknown"),
    ("0 available", 0, 1, "in_stock", "0 available", "unknown"),
    ("Unavailable", 0, 1, "in_stock", "Unavailable", "unknown"),
    ("1200 in stock, 7 units", 7, 7, "in_stock", "1200 in stock, 7 units", "in_stock"),
    ("  In\tstock :  9  ", 9, 9, "in_stock", "In stock : 9", "in_stock"),
    ("   ", 0, 0, "out_of_stock", "Out of stock", "out_of_stock"),
    ("", 0, 0, "unknown", "Unknown", "unknown"),
    (None, None, 0, "unknown", "Unknown", "unknown"),
    ("нет в наличии", 0, 0, "out_of_stock", "нет в наличии", "unknown"),
    ("есть в наличии", 0, 1, "in_stock", "есть в наличии", "unknown"),
    ("Sold out", 0, 0, "out_of_stock", "Sold out", "unknown"),
]


def test_availability(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(STOCK)], "i int, x string")
    out = (with_availability(df, "x")
           .withColumn("p", first_pattern_int(X.strip_ws("x")))
           .withColumn("mart", X.case_label("availability", STATUS_RULES, "unknown"))
           .orderBy("i").collect())
    for row, (text, pattern, qty, status, label, mart) in zip(out, STOCK):
        got = (row.available_quantity, row.availability_status, row.availability, row.mart)
        assert got == (qty, status, label, mart), text
        assert row.in_stock == (status == "in_stock"), text
        assert row.p == (pattern if text != "" else 0), text
        assert row.availability_raw == (text.strip() if text else None)


def test_parse_amount(spark):
    cases = {"£51.77": 51.77, "£1,234.50": 1234.5, "-5": 5.0, "1e3": 13.0, "51.": 51.0, ".5": 0.5,
             "1.2.3": None, ".": None, "free": None, "": None, None: None}
    assert values(spark, cases, N.parse_amount) == list(cases.values())


def test_parse_count(spark):
    cases = {"7": 7, " 7 ": 7, "+7": 7, "-3": -3, "1_000": 1000, "99999999999": 99999999999,
             "7.5": 0, "abc": 0, "": 0, "1__0": 0, "_1": 0, None: None}
    assert values(spark, cases, N.parse_count) == list(cases.values())


def test_numeric_columns_pass(spark):
    df = spark.createDataFrame([(7.9,), (-7.9,), (None,)], "x double")
    assert [r[0] for r in df.select(N.to_int_or_zero(df, "x")).collect()] == [7, -7, None]
    assert [r[0] for r in df.select(N.to_double_lenient(df, "x")).collect()] == [7.9, -7.9, None]


def test_parse_iso_ts(spark):
    run = datetime(2026, 3, 1)
    cases = {
        "2026-02-10T10:25:25.541786": datetime(2026, 2, 10, 10, 25, 25, 541786),
        "2026-02-10T10:25:25Z": datetime(2026, 2, 10, 10, 25, 25),
        "2026-02-10T10:25:25+03:30": datetime(2026, 2, 10, 6, 55, 25),
        "2026-02-10T10:25:25-0100": datetime(2026, 2, 10, 11, 25, 25),
        "2026-02-10 10:25": datetime(2026, 2, 10, 10, 25),
        "2026-02-10": datetime(2026, 2, 10),
        "bad": run, "2026-02": run, "2026-13-40": run, "": run, None: None}
    fallback = F.lit(run.isoformat()).cast("timestamp_ntz")
    got = values(spark, cases, lambda c: N.parse_iso_ts(c, fallback))
    assert got == list(cases.values())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, cases, lambda c: N.parse_iso_ts(c, fallback)) == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_completeness(spark):
    names = N.SCORED_FIELDS
    schema = ", ".join(f"{n} {'double' if 'price' in n else 'int' if n == 'rating' else 'string'}" for n in names)
    full = {n: (1.5 if "price" in n else 3 if n == "rating" else "x") for n in names}
    rows = [full, {**full, "rating": 0}, {**full, "price": 0.0, "title": ""}, dict.fromkeys(names)]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = [r[0] for r in df.select(N.completeness_score(df)).collect()]
    assert got == [100.0, 90.91, 81.82, 0.0]
    assert df.select(N.completeness_score(df, [])).first()[0] == 100.0


def test_in_range(spark):
    assert values(spark, [0, 1, 999, 1000, None], lambda c: N.in_range(c, 0, 1000), "x int") == [
        False, True, True, False, False]


def test_whitespace(spark):
    samples = ["  a\tb \x1f", "  x  ", " y\n", "", "   ", None, "a (b) c", "(a)  (b)"]
    assert values(spark, samples, X.strip_ws) == [s if s is None else s.strip() for s in samples]
    assert values(spark, samples, X.drop_parenthetical)[-2:] == ["a c", ""]
    assert values(spark, ["star-rating  Three", " x ", "", "  ", None], X.last_token) == [
        "Three", "x", None, None, None]


def test_small_text_functions(spark):
    assert values(spark, ["One", "Six", None], lambda c: X.map_lookup(c, {"One": 1}, 0)) == [1, 0, None]
    assert values(spark, ["", None, "a"], lambda c: X.first_non_empty(c, F.lit("z"))) == ["z", "z", "a"]
    assert values(spark, ["", None, "abcdef"], lambda c: X.preview(c, 3, "none")) == ["non", "non", "abc"]
    assert values(spark, [83.333, 0.0], X.percent_text, "x double") == ["83.3%", "0.0%"]
    assert values(spark, ["В НАЛИЧИИ", None], lambda c: X.contains_ci(c, "наличии")) == [True, False]
    assert values(spark, ["a"], X.md5_hex) == ["0cc175b9c0f1b6a831c399e269772661"]
    assert values(spark, ["media/a.jpg", "a.jpg", "media/"], U.basename) == ["a.jpg", "a.jpg", ""]
    long = "https://shop.example/" + "x" * 40 + "/item_7.html"
    assert values(spark, [long, "https://shop.example/a"], U.short_key) == [
        "item_7.html", "https://shop.example/a"]


BASES = ["http://h.example/a/b/c.html", "https://h.example", "https://h.example/a/?q=1#f",
         "http://h.example:8080/x/../y/z"]
HREFS = ["d.html", "./d", "../d", "../../d", "../../../d", "/r/s", "/r/../s", "//o.example/p", "?p=2", "#top",
         "", "http://z.example/q", "mailto:a@b", "..", ".", "a/./b/../c", "d/", "../d/..", "../d?x=../y#../z"]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url(spark, base):
    got = values(spark, HREFS, lambda c: U.resolve_url(F.lit(base), c))
    assert dict(zip(HREFS, got)) == {h: urljoin(base, h) for h in HREFS}


def test_unescape(spark):
    samples = ["a &amp; b", "&pound;51.77", "&#163;5", "&#xA3;6", "&copy;&middot;", "R&D", "&nope;", "a&", "&",
               "&amp;amp;", "", None, "plain", "&#8364;", "&#x1F600;!", "&quot;q&quot;", "&#0;"]
    assert values(spark, samples, H.unescape) == [
        s if s is None else stdlib_html.unescape(s) for s in samples]


def test_inner_html_counts_nesting(spark):
    page = ('<div class="other product_main2">no</div><DIV id="p" class=\'col product_main\'>a<div>b<div>c</div>'
            '</div>d</DIV><div>after</div>')
    start = H.open_tag(H.ANY, "product_main")
    cases = {page: "a<div>b<div>c</DIV></DIV>d", "<div>none</div>": "",
             '<p class="product_main">x<div>y</div>': "x<div>y</div>"}
    got = values(spark, cases, lambda c: F.lower(H.inner_html(c, start)))
    assert got == [v.lower() for v in cases.values()]


def test_patterns_where_letters_fold_to_ascii(spark):
    """Gates by words do not lose texts whose letters only fold to those words."""
    from martkit.functions.availability import PATTERN_NEEDS, QUANTITY_PATTERNS, first_pattern_int

    assert len(PATTERN_NEEDS) == len(QUANTITY_PATTERNS)
    texts = ["9 or 12 in ſtock", "9, 12 AVAıLABLE", "9, 12 LEFT", "é 9, 7 Items", "1200 in stock, 30 units", None, "", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    every = [[] for _ in QUANTITY_PATTERNS]
    got = df.select(first_pattern_int("x"), first_pattern_int("x", needs=every)).collect()
    assert [r[0] for r in got] == [r[1] for r in got] == [12, 12, 12, 7, 30, None, 0, 0]
