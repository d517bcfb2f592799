"""The whole job, its store, and the sinks."""

import json
import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martkit.operators.constraints import check_table
from martkit.plans import mart as M
from martkit.plans.mart import new_run_id, run_mart, transform
from martkit.schemas import MART_RULES, RAW_ITEM, RATING_ROWS
from martkit.session import local_frame, scratch_path
from martkit.sources.readers import TableSpec, default_ratings, jdbc_spec, load_readback, read_or_default, read_table
from martkit.sources.writers import (
    MartStore, append, export_json, init_tables, load_if_empty, overwrite, read_run_metrics, refresh_in_place,
    seed_ratings, store_items)

ORDER = ["scraped_at", "url"]


def item(url, upc, category="Travel", rating=3, score=100.0, hour=10, title="A title", price=9.5,
         availability="In stock (3 available)", **more):
    return {"url": url, "upc": upc, "category": category, "rating": rating, "data_quality_score": score,
            "scraped_at": datetime(2026, 2, 10, hour), "title": title, "price": price, "product_type": "Books",
            "availability": availability, **more}


ITEMS = [
    item("u1", "A", score=50.0, hour=10, category="Only rejected"),
    item("u2", "A", score=100.0, hour=11),
    item("u3", "B", category=" Travel ", rating=None),
    item("u4", "C", category="   ", rating=5, availability="Out of stock"),
    item("u5", "D", category=None, rating=6, availability="12 left"),
    item("u6", None, category="Art", price=None),
    item("u7", "E", title="  ", category="Art", price=123456789.0),
    item("u8", "F", score=None, category="Unscored"),
    item("u9", "G", title=None),
]


@pytest.fixture()
def raw(spark):
    return local_frame(spark, ITEMS, RAW_ITEM)


@pytest.fixture()
def store(spark):
    return MartStore(spark, scratch_path(spark, "mart"))


def test_transform_semantics(raw):
    mart = transform(raw, ORDER)
    fact = {r.book_id: r for r in mart.fact.collect()}
    assert set(fact) == {"B", "C", "D", "E", "G", None}
    names = {r.category_id: r.category for r in mart.dims["dim_categories"].collect()}
    # Rejected and unscored rows still feed the dimension; blank names do not.
    assert set(names.values()) == {"Only rejected", "Travel", "Art", "Unscored"}
    assert sorted(names) == [1, 2, 3, 4]
    assert names[fact["B"].category_id] == "Travel" and fact["B"].rating_id == 1
    assert fact["C"].category_id is None and fact["C"].rating_id == 6 and fact["C"].in_stock is False
    assert fact["D"].rating_id is None and fact["D"].in_stock is False
    assert fact["B"].in_stock is True and fact[None].price == 0.0 and fact["B"].available_quantity == 0
    assert [r.upc for r in mart.rejects.collect()] == ["A"]


def test_run_mart(spark, raw, store):
    result = run_mart(raw, store, ORDER)
    s = result.statistics
    assert (s["extraction_records"], s["records_after"], s["duplicates_removed"], s["quality"]) == (9, 8, 1, 1)
    assert s["tables"]["fact_books"] == (4 - 1, "loaded") and s["tables_loaded"] == 4
    assert s["null_profile"] == {"null_title": 1, "null_category": 1, "null_product_type": 0,
                                 "null_price": 0, "null_rating": 0}
    assert s["transformation_books"] == 3 and [r.upc for r in result.worst.collect()] == ["A"]
    tables = {t: store.read(t) for t in MART_RULES}
    for name, rules in MART_RULES.items():
        assert tables[name].schema.names == rules.schema.names
        assert [f.dataType for f in tables[name].schema] == [f.dataType for f in rules.schema]
        bad = check_table(name, tables, rules).where("violations > 0").collect()
        assert bad == [], bad
    reasons = {r.url: r.reject_reason for r in store.read("fact_rejects").collect()}
    assert reasons == {"u6": "book_id: is null", "u7": "price: not a decimal(10,2)", "u9": "title: is null"}
    stamps = {r[0] for t in ("dim_categories", "dim_product_types") for r in store.read(t).select("created_at").collect()}
    stamps |= {r[0] for r in store.read("fact_books").select("processed_at").collect()}
    assert len(stamps) == 1

    first = sorted(map(str, store.read("fact_books").drop("processed_at").collect()))
    again = run_mart(raw, store, ORDER)
    assert again.version != result.version and store.latest().name == again.version
    assert sorted(map(str, store.read("fact_books").drop("processed_at").collect())) == first
    assert store.read("fact_books", result.version).count() == 3
    runs = read_run_metrics(spark, f"{store.root}/_runs").collect()
    assert len(runs) == 2 and all(r.success and r.statistics.status == "success" for r in runs)


def test_no_rows_stops_early(spark, raw, store):
    result = run_mart(raw.limit(0), store, ORDER)
    assert result.version is None and result.statistics["status"] == "no data"
    assert [store.read(t).count() for t in MART_RULES] == [6, 0, 0, 0]


def test_failed_run_leaves_the_last_version(spark, raw, store, monkeypatch):
    run_mart(raw, store, ORDER)
    before = store.latest()

    def broken(*_, **__):
        raise RuntimeError("disk " + "x" * 400)

    monkeypatch.setattr(M, "build_fact", broken)
    with pytest.raises(RuntimeError):
        run_mart(raw, store, ORDER)
    assert store.latest() == before and store.read("fact_books").count() == 3
    last = read_run_metrics(spark, f"{store.root}/_runs").where("not success").collect()
    assert len(last) == 1 and last[0].statistics.status == "failed" and len(last[0].statistics.error) == 200


def test_init(spark, store):
    assert store.missing_tables() == list(MART_RULES)
    with pytest.raises(LookupError):
        store.read("fact_books")
    version = store.init()
    assert store.missing_tables() == [] and store.init() == version
    assert [tuple(r)[:4] for r in store.read("dim_ratings").orderBy("rating_id").collect()] == RATING_ROWS
    assert store.init(drop_existing=True) != version


def test_init_completes_a_partial_mart(spark, store):
    ratings = default_ratings(spark).where("rating_id < 3")
    store.full_refresh({"dim_ratings": ratings})
    assert store.missing_tables() == ["dim_categories", "dim_product_types", "fact_books"]
    store.init()
    assert store.missing_tables() == [] and store.read("dim_ratings").count() == 6


def test_load_if_empty_and_defaults(spark):
    spec = TableSpec(scratch_path(spark, "seed"), schema=default_ratings(spark).schema)
    seed = default_ratings(spark)
    assert read_or_default(spark, spec, seed).count() == 6
    overwrite(seed.limit(0), spec)
    assert read_or_default(spark, spec, seed).count() == 6
    assert load_if_empty(seed, spec) == "loaded"
    assert load_if_empty(seed, spec) == "skipped (already has data)"
    assert read_table(spark, spec).count() == 6
    other = TableSpec(scratch_path(spark, "seed2"), schema=seed.schema)
    assert load_if_empty(seed, other) == "loaded (fallback)"


def test_read_or_default_raises_other_failures(spark):
    with pytest.raises(Exception):
        read_or_default(spark, TableSpec("/x", "no_such_format"), default_ratings(spark)).collect()


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_formats(spark, fmt):
    df = spark.range(20).select("id", F.concat(F.lit("név "), "id").alias("name"), (F.col("id") / 3).alias("x"))
    spec = TableSpec(scratch_path(spark, fmt), fmt, df.schema)
    append(df.where("id < 9"), spec)
    append(df.where("id >= 9"), spec)
    assert sorted(read_table(spark, spec).collect()) == sorted(df.collect())


def test_catalog_table(spark, tmp_path):
    spec = TableSpec("martkit_probe", "table", options={"path": str(tmp_path / "probe")})
    overwrite(spark.range(3), spec)
    append(spark.range(2), spec)
    assert read_table(spark, TableSpec("martkit_probe", "table")).count() == 5
    spark.sql("drop table martkit_probe")


def test_jdbc_options_are_passed(spark):
    spec = jdbc_spec("jdbc:x:y", "t", "u", "p", "d", split=("id", 0, 1000, 8), fetchsize="5000")
    assert spec.options == {"url": "jdbc:x:y", "dbtable": "t", "user": "u", "password": "p", "driver": "d",
                            "fetchsize": "5000", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000",
                            "numPartitions": "8"}


def test_column_types():
    from martkit.schemas import DIM_RATINGS, FACT
    from martkit.sources.writers import column_types

    assert column_types(DIM_RATINGS) == "rating_name VARCHAR(10), rating_description VARCHAR(100)"
    assert "price DECIMAL(10,2)" in column_types(FACT) and "description" not in column_types(FACT)


def test_init_tables_in_a_catalog(spark, tmp_path):
    specs = {t: TableSpec(f"probe_{t}", "table", options={"path": str(tmp_path / t)}) for t in MART_RULES}
    assert init_tables(spark, specs) == list(MART_RULES)
    assert init_tables(spark, specs) == []
    assert [read_table(spark, TableSpec(s.path, "table")).count() for s in specs.values()] == [6, 0, 0, 0]
    fact = local_frame(spark, [{"book_id": "b", "title": "t"}], MART_RULES["fact_books"].schema)
    for _ in range(2):
        assert refresh_in_place({"fact_books": fact}, specs) == {"fact_books": "loaded"}
    assert read_table(spark, specs["fact_books"]).count() == 1
    assert init_tables(spark, specs, drop_existing=True) == list(MART_RULES)
    assert read_table(spark, specs["fact_books"]).count() == 0
    for s in specs.values():
        spark.sql(f"drop table {s.path}")


def test_json_feed_keeps_null_fields(spark, raw):
    path = scratch_path(spark, "feed")
    export_json(raw.where("upc is null").select("url", "upc", "scraped_at"), path)
    lines = [json.loads(x) for f in os.listdir(path) if f.endswith(".json") for x in open(f"{path}/{f}")]
    assert lines == [{"url": "u6", "upc": None, "scraped_at": "2026-02-10T10:00:00.000000"}]


def test_store_items_modes(spark, raw):
    held = TableSpec(scratch_path(spark, "held"), schema=RAW_ITEM)
    overwrite(local_frame(spark, [item("u1", "old", description="kept"), item("u0", "Z")], RAW_ITEM), held)
    for clear, urls in ((True, 9), (False, 10)):
        out = TableSpec(scratch_path(spark, "out"), schema=RAW_ITEM)
        store_items(raw, held, out, "url", ["scraped_at"], clear, {"available_quantity": 0})
        got = {r.url: r for r in read_table(spark, out).collect()}
        assert len(got) == urls and got["u9"].available_quantity == 0
        assert got["u1"].description == (None if clear else "kept") and got["u1"].upc == "A"


def test_readback_reports_missing_tables(spark):
    got = load_readback(spark, {"gone": TableSpec(scratch_path(spark, "gone"))})
    assert isinstance(got["gone"], Exception)


def test_a_filled_table_survives_an_unrelated_error(spark):
    rules = {"dim_ratings": MART_RULES["dim_ratings"]}
    path = scratch_path(spark, "ratings")
    good = TableSpec(path, schema=rules["dim_ratings"].schema)
    overwrite(seed_ratings(spark), good)
    bad = TableSpec(path, "parquet", None, {"mergeSchema": "no such value"})
    for act in (lambda: init_tables(spark, {"dim_ratings": bad}, rules), lambda: load_if_empty(seed_ratings(spark), bad)):
        with pytest.raises(Exception):
            act()
        assert read_table(spark, good).count() == 6


def test_run_id_shape():
    now = datetime(2026, 2, 10, 10, 25, 25)
    ids = {new_run_id(now) for _ in range(50)}
    assert len(ids) == 50 and all(re.fullmatch(r"etl_run_20260210_102525_[0-9a-f]{8}", i) for i in ids)
