"""The shape of the physical plans that scale depends on."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from martkit.functions.availability import first_pattern_int, with_availability
from martkit.functions.numbers import parse_amount
from martkit.operators import dedup
from martkit.operators.clean import clean
from martkit.operators.dedup import dedup_keep_first, later_duplicates
from martkit.operators.keys import build_dimension
from martkit.operators.lookup import DimRef, lookup_dimensions, orphan_rows
from martkit.operators.merge import reduce_updates, upsert
from martkit.plans.items import pages_to_items
from martkit.plans import mart
from martkit.plans.mart import profile_raw, transform
from martkit.session import materialize, scratch_root, sized_for, use_scratch
from catalog.feed import MINIMUM, ORDER, raw_items


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_dedup_limits_before_the_shuffle(spark, sf_dir):
    text = plan(dedup_keep_first(raw_items(spark, sf_dir), "upc", ORDER))
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning(upc")
    assert text.count("WindowGroupLimit") == 2 and exchange < partial
    assert text.count("Exchange hashpartitioning") == 1


def test_fact_is_not_shuffled(spark, sf_dir):
    fact = transform(raw_items(spark, sf_dir), ORDER, minimum=MINIMUM).fact
    text = plan(fact)
    assert text.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert re.search(r"PushedFilters: \[IsNotNull\(data_quality_score\), GreaterThanOrEqual\(data_quality_score", text)


def test_keys_rank_hashes_in_ranges(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = final_plan(build_dimension(docs, "text", "text_id"))
    # Hashes alone are sorted for the ranks; the texts are read once, for the join at the end.
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and not any("text#" in line for line in windows)
    assert text.count("ReadSchema: struct<text:string,_hash:string>") == 1
    # Only the totals per group of ranges meet in one partition.
    single = text[text.index("SinglePartition"):]
    assert "_group" in single.split("\n")[1]


def test_run_reads_the_source_once(spark, sf_dir, monkeypatch):
    raw, plans = raw_items(spark, sf_dir), []
    monkeypatch.setattr(mart, "materialize", lambda df, name: plans.append(plan(df)) or materialize(df, name))
    kept, counts = mart.first_rows_and_counts(raw, "upc", ORDER)
    # Counters ride along: no aggregate over rows of the source, one window with a limit before its shuffle.
    assert len(plans) == 1 and plans[0].count("lineitem.parquet") == plan(raw).count("lineitem.parquet")
    assert "SortAggregate" not in plans[0] and "CollectMetrics" in plans[0] and "WindowGroupLimit" in plans[0]
    assert counts == profile_raw(raw).first().asDict()
    first = dedup_keep_first(clean(raw), "upc", ORDER)
    assert kept.exceptAll(first).isEmpty() and kept.count() == first.count()


def test_counts_of_a_stage_that_ran_again_are_taken_anew(spark, sf_dir, monkeypatch):
    raw = raw_items(spark, sf_dir)
    monkeypatch.setattr(mart, "ran_again", lambda context, group: True)
    asked = []
    monkeypatch.setattr(mart, "profile_raw", lambda df: asked.append(1) or profile_raw(df))
    assert mart.first_rows_and_counts(raw, "upc", ORDER)[1]["records"] == raw.count() and asked == [1]


def test_attempts_are_looked_up(spark):
    context = spark.sparkContext
    context.setLocalProperty("spark.jobGroup.id", "once")
    spark.range(10).groupBy("id").count().collect()
    context.setLocalProperty("spark.jobGroup.id", None)
    assert not mart.ran_again(context, "once") and mart.ran_again(context, "never heard of")


@pytest.mark.parametrize("column", ["label", "quantity", "amount"])
def test_text_functions_are_generated_code(spark, column):
    texts = materialize(spark.createDataFrame([("In stock (3 available)",)], "x string"), "texts")
    made = {"label": lambda: with_availability(texts, "x"),
            "quantity": lambda: texts.select(first_pattern_int("x").alias("q")),
            "amount": lambda: texts.select(parse_amount("x").alias("a"))}[column]()
    bare = [line for line in plan(made).splitlines() if "Project" in line and not re.search(r"\*\(\d+\)", line)
            and not re.match(r"\W*\(\d+\) Project", line)]
    assert not bare, bare


def test_unsized_lookup_does_not_force_a_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = spark.range(100).select(F.when(F.col("id") > 30, F.col("id").cast("string")).alias("k"), "id")
        dim = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("dim_id"))
        joined = lookup_dimensions(fact, [DimRef(dim, "k", "k", "dim_id")])
        text = plan(joined)
        assert "SortMergeJoin" in text and "Broadcast" not in text
        # Keyless rows are spread: the shuffle has a second column.
        assert re.search(r"hashpartitioning\(k#\d+, _spread#\d+L", text)
        spread = joined.where("k is null").select(F.spark_partition_id()).distinct().count()
        assert spread > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_wide_rows_of_orphans_are_not_shuffled(spark, tmp_path):
    spark.range(50_000).selectExpr("nullif(id % 1000, 7) as fk", "repeat('x', 50) as wide").write.parquet(f"{tmp_path}/fact")
    spark.range(998).selectExpr("id as pk").write.parquet(f"{tmp_path}/dim")
    out = orphan_rows(spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/dim"), "fk", "pk")
    assert {r.fk for r in out.collect()} == {998, 999} and out.count() == 100
    text = final_plan(out)
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert not any("wide" in line for line in text.splitlines() if "Exchange" in line)


def test_updates_are_folded_before_the_shuffle(spark):
    updates = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"),
                                       F.col("id").cast("string").alias("v"))
    text = plan(reduce_updates(updates, "k", ["seq"]))
    assert "partial_max_by" in text and text.count("Exchange hashpartitioning") == 1


def test_later_duplicates_shuffle_on_key_and_order(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        text = plan(later_duplicates(lines, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]))
        assert re.search(r"hashpartitioning\(coalesce\(l_orderkey#\d+L, 0\), isnull\(l_orderkey#\d+L\), coalesce\(l_shipdate", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_later_duplicates_read_the_source_twice(spark, sf_dir, monkeypatch):
    raw, plans = raw_items(spark, sf_dir), []
    keep = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, name: plans.append(plan(df)) or keep(df, name))
    plans.append(plan(later_duplicates(raw, ["upc"], ORDER)))
    tied = raw.unionByName(raw)
    again = later_duplicates(tied, ["upc"], ORDER)
    assert [p.count("lineitem.parquet") for p in plans] == [1, 1, 2, 2] and "parquet" in plan(again)
    assert plan(again).count("lineitem.parquet") == 0
    assert again.count() == 2 * raw.count() - raw.select("upc").distinct().count()


def test_pages_stay_in_one_stage_and_closed_ones_in_the_jvm(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text = plan(pages_to_items(pages, F.lit("2026-02-10 00:00:00").cast("timestamp_ntz")))
    assert "Exchange" not in text and "ReadSchema: struct<url:string,html:string>" in text
    # Only pages that leave elements open go through the parser: all others are sent as NULL.
    assert text.count("ArrowEvalPython") == 1 and len(re.findall(r"closed\(CASE WHEN", text)) >= 1


def test_cleaning_reads_only_what_is_asked_for(spark, sf_dir):
    text = plan(clean(raw_items(spark, sf_dir)).select("upc", "price"))
    assert "l_discount" not in text and "p_name" not in text


def test_materialize_uses_the_shared_folder(spark):
    df = materialize(spark.range(5), "probe")
    assert sorted(r.id for r in df.collect()) == list(range(5))
    assert all(f.removeprefix("file:").lstrip("/").startswith(scratch_root(spark).lstrip("/")) for f in df.inputFiles())
    assert "Range" not in plan(df)


def test_hot_key_of_an_unsized_lookup_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # A third of the rows has one key, a third has none.
        fact = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").when(
            F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 997)).alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
        dim = spark.range(997).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("dim_id")).union(
            spark.range(1).select(F.lit("hot"), F.lit(-1).cast("bigint")))
        joined = lookup_dimensions(fact, [DimRef(dim, "k", "k", "dim_id")])
        counts = joined.selectExpr("count(*)", "count_if(dim_id = -1)", "count_if(dim_id is null)", "max(pad)")
        assert tuple(counts.collect()[0])[:3] == (60000, 20000, 20000)
        assert "skew=true" in plan(counts)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_few_updates_do_not_shuffle_the_target(spark):
    target = materialize(spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v")), "target")
    updates = spark.range(3).select(F.col("id").alias("k"), F.lit("y").alias("v"), F.col("id").alias("seq"))
    text = plan(upsert(target, updates, "k", ["seq"], few=True))
    assert "SortMergeJoin" not in text
    left = text[:text.index("LeftAnti")]
    assert "LeftOuter" in left and "Exchange hashpartitioning" not in left


def test_scratch_folder_is_the_one_the_session_names():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    named = Session(spark_checkpoint_dir="s3a://shared/ck/", spark_master="spark://h:7077")
    assert scratch_root(named) == "s3a://shared/ck"
    unnamed = Session(spark_master="local[2]")
    unnamed.sparkContext = SimpleNamespace(applicationId="app-of-this-test")
    with pytest.raises(ValueError):
        scratch_root(unnamed)
    use_scratch(unnamed, "/shared/chosen/")
    assert scratch_root(unnamed) == "/shared/chosen"


def test_sizes():
    small, large = sized_for(1 << 30), sized_for(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.files.maxPartitionBytes"]) > int(small["spark.sql.files.maxPartitionBytes"])
    for size in (1 << 40, 10 << 40, 100 << 40):
        conf = sized_for(size)
        partitions, split = int(conf["spark.sql.shuffle.partitions"]), int(conf["spark.sql.files.maxPartitionBytes"])
        assert size / (size / split) / partitions > 100 << 10
