"""Operators on hand-built rows, and properties that hold for any rows."""

import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martkit.operators import clean as C
from martkit.operators.constraints import check_numeric, check_table, check_tables_present
from martkit.operators.dedup import dedup_keep_first, dedup_stats, later_duplicates
from martkit.operators.keys import build_dimension, range_digits, surrogate_keys
from martkit.operators.lookup import BROADCAST_BYTES, DimRef, fk_orphans, lookup_dimensions, measured
from martkit.operators.merge import insert_if_absent, upsert, upsert_stats
from martkit.operators.quality import completeness_grade, quality_rejects, quality_report, split_by_quality
from martkit.operators.stats import delay_stats, kind_share, latest_values, load_verification, throughput, top_k
from martkit.schemas import MART_RULES, RAW_RULES


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def at(hour):
    return None if hour is None else datetime(2026, 2, 10, hour)


DUPES = [("A", at(10), 50.0), ("A", at(11), 100.0), ("B", None, 100.0), ("B", at(9), 100.0),
         (None, at(8), 100.0), (None, at(9), 100.0)]


def test_dedup_nulls_and_gate(spark):
    df = spark.createDataFrame(DUPES, "upc string, scraped_at timestamp_ntz, data_quality_score double")
    kept = dedup_keep_first(df, "upc", ["scraped_at"])
    assert rows(kept) == [(None, at(8), 100.0), ("A", at(10), 50.0), ("B", None, 100.0)]
    accepted, rejected = split_by_quality(kept)
    assert [r.upc for r in accepted.orderBy("upc").collect()] == [None, "B"]
    assert [r.upc for r in rejected.collect()] == ["A"]
    assert rows(dedup_stats(df, "upc")) == [(6, 3, 3)]
    assert sorted(later_duplicates(df, ["upc"], ["scraped_at"]).count() for _ in range(2)) == [3, 3]


def test_null_scores(spark):
    df = spark.createDataFrame([("a", 84.9), ("b", 85.0), ("c", None)], "k string, data_quality_score double")
    accepted, rejected = split_by_quality(df)
    assert (accepted.count(), rejected.count()) == (1, 1)
    assert quality_rejects(df, null_score="reject").count() == 2
    with pytest.raises(ValueError):
        quality_rejects(df, null_score="keep")


def test_hot_key_dedup_against_brute_force(spark):
    rng = random.Random(7)
    data = [(rng.choice(["hot", "hot", None, f"k{rng.randrange(300)}"]), rng.randrange(50), i) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, t int, i int").repartition(8, "i")
    best = {}
    for k, t, i in data:
        best[k] = min(best.get(k, (t, i)), (t, i))
    kept = {r.k: (r.t, r.i) for r in dedup_keep_first(df, "k", ["t", "i"]).collect()}
    assert kept == best
    removed = {r.i for r in later_duplicates(df, ["k"], ["t", "i"]).collect()}
    assert removed == {i for k, t, i in data if best[k] != (t, i)}


@pytest.mark.parametrize("range_rows", [1, 7, 100, 10**6])
def test_surrogate_keys_are_the_dense_rank(spark, range_rows):
    values = [f"värde {i}" for i in range(1500)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.id for r in surrogate_keys(df, "v", "id", range_rows).collect()}
    ranked = sorted(values, key=lambda v: hashlib.md5(v.encode()).hexdigest())
    assert got == {v: i + 1 for i, v in enumerate(ranked)}


def test_surrogate_keys_edges(spark):
    df = spark.createDataFrame([("",), (None,), ("x",), ("x",)], "v string")
    assert rows(build_dimension(df, "v", "id")) == [(1, "x")]
    assert build_dimension(df.where("v = 'none'"), "v", "id").count() == 0
    assert [range_digits(n, 1000) for n in (0, 1000, 1001, 16_000, 16_001, 10**12)] == [1, 1, 1, 1, 2, 8]


@pytest.mark.parametrize("size", ["measured", None, BROADCAST_BYTES + 1])
def test_lookup(spark, size):
    items = spark.createDataFrame(
        [(1, " Travel "), (2, "Travel"), (3, ""), (4, "   "), (5, None), (6, "Art"), (7, None)], "i int, category string")
    items = C.trim_columns(items, ["category"])
    dim = spark.createDataFrame([(1, "Travel"), (2, "Art")], "category_id long, category string")
    ref = DimRef(dim, "category", "category", "category_id", None if size == "measured" else size)
    if size == "measured":
        ref = measured(ref)
        assert ref.size == len("TravelArt") + 2 * 16
    out = lookup_dimensions(items, [ref])
    assert [(r.i, r.category_id) for r in out.orderBy("i").collect()] == [
        (1, 1), (2, 1), (3, None), (4, None), (5, None), (6, 2), (7, None)]


def test_lookup_keeps_equal_rows(spark):
    items = spark.createDataFrame([(None,), (None,), ("a",), ("a",)], "k string")
    dim = spark.createDataFrame([("a", 1)], "k string, id long")
    assert rows(lookup_dimensions(items, [DimRef(dim, "k", "k", "id")])) == [
        (None, None), (None, None), ("a", 1), ("a", 1)]


def test_trim_is_ascii_space_only(spark):
    df = spark.createDataFrame([(" \ta  ",)], "title string")
    assert C.trim_columns(df, ["title"]).first()[0] == "\ta "


def test_fill_nulls_leaves_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "price double")
    got = [r[0] for r in C.fill_nulls(df, {"price": 0.0}).collect()]
    assert got[0] == 0.0 and got[1] != got[1]


UPSERT_SCHEMA = "url string, price double, title string, available_quantity int, in_stock boolean"


def test_upsert(spark):
    target = spark.createDataFrame([("u1", 1.0, "T", 3, True)], UPSERT_SCHEMA)
    updates = spark.createDataFrame([
        ("u1", None, "X", None, None, 1), ("u2", None, None, None, None, 2),
        ("u3", 1.0, None, None, None, 3), ("u3", None, "Y", None, None, 4), (None, 9.0, "Z", 1, True, 5)],
        UPSERT_SCHEMA + ", seq int")
    defaults = {"available_quantity": 0, "in_stock": False}
    once = upsert(target, updates, "url", ["seq"], defaults)
    want = [("u1", 1.0, "X", 3, True), ("u2", None, None, 0, False), ("u3", 1.0, "Y", 0, False)]
    assert rows(once) == want
    assert rows(upsert(once, updates, "url", ["seq"], defaults)) == want
    assert rows(upsert_stats(target, updates, "url", ["seq"])) == [(5, 2, 2, 80.0)]
    empty = upsert_stats(target, updates.limit(0), "url", ["seq"])
    assert rows(empty) == [(0, 0, 0, 0.0)]


def test_upsert_null_order(spark):
    target = spark.createDataFrame([], "k string, v string")
    updates = spark.createDataFrame([("a", "late", 2), ("a", "early", None), ("b", "only", None)], "k string, v string, t int")
    assert rows(upsert(target, updates, "k", ["t"])) == [("a", "late"), ("b", "only")]


def test_upsert_against_brute_force(spark):
    rng = random.Random(3)
    target = {f"k{i}": [rng.choice([None, i]), rng.choice([None, str(i)])] for i in range(50)}
    updates = [(rng.choice(["k1", "k1", f"k{rng.randrange(90)}"]), rng.choice([None, rng.randrange(9)]),
                rng.choice([None, "x", "y"]), seq) for seq in range(900)]
    want = {k: list(v) for k, v in target.items()}
    for k, a, b, _ in updates:
        row = want.setdefault(k, [None, None])
        row[0] = row[0] if a is None else a
        row[1] = row[1] if b is None else b
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], "k string, a int, b string")
    u = spark.createDataFrame(updates, "k string, a int, b string, seq int").repartition(8)
    assert rows(upsert(t, u, "k", ["seq"]), "k") == sorted((k, *v) for k, v in want.items())


def test_few_updates_give_the_same_table(spark):
    target = spark.createDataFrame([(f"k{i}", i, None) for i in range(40)], "k string, a int, b string")
    updates = spark.createDataFrame(
        [("k3", None, "x", 1), ("k3", 7, None, 2), ("new", None, None, 3), ("new", 1, "y", 4), (None, 1, "z", 5)],
        "k string, a int, b string, seq int")
    defaults = {"b": "none"}
    got = rows(upsert(target, updates, "k", ["seq"], defaults, few=True))
    assert got == rows(upsert(target, updates, "k", ["seq"], defaults)) and len(got) == 41
    assert ("k3", 7, "x") in got and ("new", 1, "y") in got
    again = upsert(target, updates.limit(0), "k", ["seq"], defaults, few=True)
    assert rows(again) == rows(target)


def test_insert_defaults(spark):
    run = F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")
    schema = "url string, scraped_at timestamp_ntz, available_quantity int, in_stock boolean"
    target = spark.createDataFrame([("old", None, None, None)], schema)
    updates = spark.createDataFrame([("new", None, None, None, 1), ("old", None, None, None, 2)], schema + ", seq int")
    got = rows(upsert(target, updates, "url", ["seq"], C.insert_defaults(run)))
    assert got == [("new", datetime(2026, 3, 1), 0, False), ("old", None, None, None)]
    filled = C.apply_insert_defaults(target, C.insert_defaults(run)).first()
    assert tuple(filled) == ("old", datetime(2026, 3, 1), 0, False)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "k int, v string")
    assert rows(insert_if_absent(target, new, "k", ["v"])) == [(1, "a"), (2, "c")]


def test_delay_stats(spark):
    log = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "a", 0.5)], "seq int, key string, delay double")
    got = delay_stats(log, "key", "delay", "seq").first()
    assert (got.request_count, got.total_delay, round(got.avg_delay, 4), got.min_delay, got.max_delay) == (
        3, 3.5, 1.1667, 0.5, 2.0)
    assert [tuple(r) for r in top_k(latest_values(log, "key", "delay", "seq"), "delay").collect()] == [
        ("b", 2.0), ("a", 0.5)]
    nothing = delay_stats(log.limit(0), "key", "delay", "seq").first()
    assert (nothing.request_count, nothing.avg_delay) == (0, None)


def test_kind_share_and_throughput_of_nothing(spark):
    log = spark.createDataFrame([], "kind string, ts timestamp_ntz")
    assert kind_share(log, F.col("kind") == "x", "a", "b").first().total == 0
    assert throughput(log, "ts").first().rows_per_second is None
    one = spark.createDataFrame([("x", at(1))], "kind string, ts timestamp_ntz")
    assert throughput(one, "ts").first().rows_per_second is None
    assert tuple(kind_share(one, F.col("kind") == "x", "a", "b").first()) == (1, 1, 0, 100.0, 0.0)


def test_grades(spark):
    df = spark.createDataFrame([(90.0,), (89.99,), (70.0,), (69.9,)], "r double")
    assert [r[0] for r in df.select(completeness_grade("r")).collect()] == ["ok", "warning", "warning", "critical"]


def test_quality_report(spark):
    df = spark.createDataFrame([(f"u{i:02}", None if i % 2 else "t" * 60, float(i)) for i in range(13)],
                               "upc string, title string, data_quality_score double")
    totals, worst = quality_report(df, "upc")
    assert tuple(totals.first()) == (13, 0.0, 12.0, 3)
    lines = worst.collect()
    assert len(lines) == 10 and lines[0].title_preview == "t" * 50 and lines[1].title_preview == "Без названия"
    assert lines[3].score_text == "3.0%"


def test_required_and_quarantine(spark):
    df = spark.createDataFrame([
        ("u", "t", 0.0), (None, "", 2.0), ("x" * 501, "t", 5.0)], "url string, title string, price double")
    assert [r[0] for r in df.select(C.required_fields(df)).collect()] == [["price"], ["title", "url"], []]
    good, bad = C.quarantine(df, C.storage_problems(df, RAW_RULES))
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["url: is null", "url: longer than 500"]
    assert C.enforce_schema(good, RAW_RULES.schema).columns == RAW_RULES.schema.names


def test_numeric_bound(spark):
    df = spark.createDataFrame([(99999999.99,), (99999999.994,), (99999999.995,), (1e300,), (float("nan"),), (None,),
                                (-1e9,)], "price double")
    wide = check_numeric(df, "price").collect()
    cast = df.where("price is not null and try_cast(price as decimal(10,2)) is null").collect()
    assert len(wide) == len(cast) == 4


def test_check_table_and_presence(spark):
    ratings = spark.createDataFrame([(1, 0, "Zero"), (1, 7, "a name too long"), (None, None, None)],
                                    "rating_id int, rating_value int, rating_name string")
    ratings = C.enforce_schema(ratings, MART_RULES["dim_ratings"].schema)
    found = {r.rule: r.violations for r in check_table("dim_ratings", {"dim_ratings": ratings}, MART_RULES["dim_ratings"]).collect()}
    assert {k: v for k, v in found.items() if v} == {
        "not_null(rating_id)": 1, "not_null(rating_value)": 1, "not_null(rating_name)": 1,
        "length(rating_name)": 1, "range(rating_value)": 1, "primary_key(rating_id)": 2}
    missing = check_tables_present(spark, list(MART_RULES), ["dim_ratings", "other"])
    assert missing.count() == 3


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    dim = spark.createDataFrame([(2,), (2,)], "pk int")
    assert rows(fk_orphans(fact, dim, "fk", "pk")) == [(1, 2)]


def test_load_verification_reports_errors(spark):
    got = rows(load_verification({"a": spark.range(2), "b": spark.range(0), "c": ValueError("x" * 200)}))
    assert got == [("a", 2, "loaded", None), ("b", 0, "empty", None), ("c", 0, "error", "x" * 100)]
    with pytest.raises(ValueError):
        load_verification({"c": ValueError("x")})
