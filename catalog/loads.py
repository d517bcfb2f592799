"""Whole jobs: sinks read back, the mart run, and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from martkit.operators.clean import enforce_schema, quarantine, stamp, storage_problems, validate_items
from martkit.operators.merge import upsert
from martkit.operators.stats import load_verification
from martkit.plans.mart import run_mart, transform
from martkit.session import scratch_path
from martkit.sources.readers import TableSpec, load_readback, read_or_default, read_table
from martkit.sources.writers import (
    MartStore, append, export_json, init_tables, load_if_empty, overwrite, read_run_metrics, refresh_in_place,
    store_items)
from martkit.streaming.ingest import ChangeLog, read_stream, stream_ingest
from martkit.schemas import MART_RULES, TableRules, col, text
from catalog import query, table
from catalog.feed import COLUMNS, DEDUP, DIMS, FACT, MINIMUM, ORDER, raw_items
from catalog.merges import DEFAULTS, FOLDED, ORDER as UPDATE_ORDER, supplier_updates


@query("sink_roundtrip", "select * from orders")
def sink_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    spec = TableSpec(scratch_path(spark, "orders"), schema=orders.schema)
    done = F.col("o_orderstatus").eqNullSafe("F")
    append(orders.where(done), spec)
    append(orders.where(~done), spec)
    return read_table(spark, spec)


@query("csv_roundtrip", "select * from customer")
def csv_roundtrip(spark, sf):
    customers = table(spark, sf, "customer")
    spec = TableSpec(scratch_path(spark, "customer"), "csv", customers.schema, {"header": "true"})
    overwrite(customers, spec)
    return read_table(spark, spec)


@query("json_roundtrip", "select * from events")
def json_roundtrip(spark, sf):
    events = table(spark, sf, "events")
    path = scratch_path(spark, "events")
    export_json(events, path)
    return read_table(spark, TableSpec(path, "json", events.schema))


@query("load_if_empty", """select 'loaded (fallback)' as first_load, 'skipped (already has data)' as second_load,
  count(*) as records from supplier""")
def seed_once(spark, sf):
    suppliers = table(spark, sf, "supplier")
    spec = TableSpec(scratch_path(spark, "supplier"), schema=suppliers.schema)
    first, second = load_if_empty(suppliers, spec), load_if_empty(suppliers, spec)
    return read_table(spark, spec).agg(F.count("*").alias("records")).select(
        F.lit(first).alias("first_load"), F.lit(second).alias("second_load"), "records")


@query("read_or_default", """select 'absent' as source, p_partkey, p_name from part
union all select 'empty', p_partkey, p_name from part union all select 'present', s_suppkey, s_name from supplier""")
def with_default(spark, sf):
    default = table(spark, sf, "part").select("p_partkey", "p_name")
    absent = TableSpec(scratch_path(spark, "absent"))
    empty = TableSpec(scratch_path(spark, "empty"), schema=default.schema)
    overwrite(spark.createDataFrame([], default.schema), empty)
    present = TableSpec(f"{sf}/supplier.parquet")
    parts = {"absent": read_or_default(spark, absent, default), "empty": read_or_default(spark, empty, default),
             "present": read_or_default(spark, present, default).selectExpr("s_suppkey as p_partkey", "s_name as p_name")}
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("source"), "p_partkey", "p_name")
        out = one if out is None else out.unionByName(one)
    return out


@query("clear_before_run", f"""with {FOLDED}
select s_suppkey, s_name, coalesce(s_nationkey, -1) as s_nationkey, s_acctbal from folded""")
def cleared(spark, sf):
    held = TableSpec(f"{sf}/supplier.parquet", schema=table(spark, sf, "supplier").schema)
    out = TableSpec(scratch_path(spark, "items"), schema=held.schema)
    store_items(supplier_updates(spark, sf), held, out, "s_suppkey", UPDATE_ORDER, True, DEFAULTS)
    return read_table(spark, out)


@query("keep_before_run", f"""with {FOLDED}
select s_suppkey, coalesce(f.s_name, s.s_name) as s_name,
  coalesce(f.s_nationkey, s.s_nationkey, -1) as s_nationkey, coalesce(f.s_acctbal, s.s_acctbal) as s_acctbal
from supplier s full outer join folded f using (s_suppkey)""")
def kept_and_merged(spark, sf):
    held = TableSpec(f"{sf}/supplier.parquet", schema=table(spark, sf, "supplier").schema)
    out = TableSpec(scratch_path(spark, "items"), schema=held.schema)
    store_items(supplier_updates(spark, sf), held, out, "s_suppkey", UPDATE_ORDER, False, DEFAULTS)
    return read_table(spark, out)


def finished_mart(spark, sf):
    store = MartStore(spark, scratch_path(spark, "mart"))
    return store, run_mart(raw_items(spark, sf), store, ORDER, MINIMUM)


_GOOD = "book_id is not null and title is not null"


@query("mart_fact", f"""with {FACT} select * replace (cast(category_id as int) as category_id,
  cast(product_type_id as int) as product_type_id) from fact where {_GOOD}""")
def mart_fact(spark, sf):
    store, _ = finished_mart(spark, sf)
    return store.read("fact_books").drop("processed_at").withColumn("price", F.col("price").cast("double"))


@query("mart_refused", f"""with {FACT} select book_id, title, url, concat_ws('; ',
  case when book_id is null then 'book_id: is null' end, case when title is null then 'title: is null' end)
  as reject_reason from fact where not ({_GOOD})""")
def mart_refused(spark, sf):
    store, _ = finished_mart(spark, sf)
    return store.read("fact_rejects").select("book_id", "title", "url", "reject_reason")


_LONG = COLUMNS["category"]
_LONG_DIMS = DIMS.replace(_LONG, f"case when l_partkey % 19 = 0 then repeat({_LONG}, 40) else {_LONG} end")


@query("mart_dim_rejects", f"""with {_LONG_DIMS}
select 'dim_categories' as table_name, category_id as id, category as value, 'category: longer than 200' as reject_reason
from categories where length(category) > 200""")
def mart_dim_rejects(spark, sf):
    """Members of a dimension that its declared table refuses."""
    raw = raw_items(spark, sf)
    long = raw.withColumn("category", F.when(F.col("l_partkey") % 19 == 0, F.repeat("category", 40)).otherwise(
        F.col("category")))
    store = MartStore(spark, scratch_path(spark, "mart"))
    run_mart(long, store, ORDER, MINIMUM)
    return store.read("dim_rejects")


@query("mart_dimensions", f"""with {FACT}
select 'dim_ratings' as table_name, cast(rating_id as int) as id, case rating_value when 0 then 'Zero' when 1 then 'One'
  when 2 then 'Two' when 3 then 'Three' when 4 then 'Four' else 'Five' end as value from ratings
union all select 'dim_categories', cast(category_id as int), category from categories
union all select 'dim_product_types', cast(product_type_id as int), product_type from product_types""")
def mart_dimensions(spark, sf):
    store, _ = finished_mart(spark, sf)
    named = {"dim_ratings": ("rating_id", "rating_name"), "dim_categories": ("category_id", "category"),
             "dim_product_types": ("product_type_id", "product_type")}
    out = None
    for name, (key, value) in named.items():
        one = store.read(name).select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(value).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


@query("mart_verification", f"""with {FACT}
select 'dim_ratings' as table_name, count(*) as records, 'loaded' as status, cast(null as varchar) as error from ratings
union all select 'dim_categories', count(*), 'loaded', null from categories
union all select 'dim_product_types', count(*), 'loaded', null from product_types
union all select 'fact_books', count(*), 'loaded', null from fact where {_GOOD}""")
def mart_verification(spark, sf):
    store, _ = finished_mart(spark, sf)
    return load_verification(load_readback(spark, {t: store.spec(t) for t in MART_RULES}))


@query("run_mart_summary", f"""with {FACT}
select 'mart' as etl_name, true as success, (select count(*) from feed) as extraction_records,
  (select count(*) from fact where {_GOOD}) as transformation_books,
  (select count(*) from kept where data_quality_score < {MINIMUM}) as quality, 4 as tables_loaded, 'success' as status""")
def run_mart_summary(spark, sf):
    store, _ = finished_mart(spark, sf)
    return read_run_metrics(spark, f"{store.root}/_runs").select(
        "etl_name", "success", "statistics.extraction_records", "statistics.transformation_books",
        "statistics.quality", "statistics.tables_loaded", "statistics.status")


@query("refresh_in_place", f"""with {FACT}
select 'dim_ratings' as table_name, 'skipped (already has data)' as status, count(*) as records from ratings
union all select 'dim_categories', 'loaded', count(*) from categories
union all select 'dim_product_types', 'loaded', count(*) from product_types
union all select 'fact_books', 'loaded', count(*) from fact where {_GOOD}""")
def refreshed(spark, sf):
    specs = {t: TableSpec(scratch_path(spark, t), schema=r.schema) for t, r in MART_RULES.items()}
    init_tables(spark, specs)
    mart = transform(raw_items(spark, sf), ORDER, minimum=MINIMUM)
    good, _ = quarantine(mart.fact, storage_problems(mart.fact, MART_RULES["fact_books"]))
    tables = {t: enforce_schema(df, MART_RULES[t].schema) for t, df in {**mart.dims, "fact_books": good}.items()}
    # Twice: a refresh replaces what the one before it left.
    for _ in range(2):
        status = refresh_in_place(tables, specs)
    counts = load_verification({t: read_table(spark, s) for t, s in specs.items()})
    names = F.create_map(*[F.lit(x) for kv in status.items() for x in kv])
    return counts.select("table_name", F.try_element_at(names, F.col("table_name")).alias("status"), "records")


@query("mart_report", f"""with {DEDUP}
select count(*) as records_after, count(*) filter (where data_quality_score < {MINIMUM}) as low,
  greatest(count(*) filter (where data_quality_score < {MINIMUM}) - 10, 0) as not_listed from kept""")
def mart_report(spark, sf):
    store, result = finished_mart(spark, sf)
    low = store.read("quality_rejects")
    return low.agg(F.count("*").alias("low")).select(
        F.lit(result.statistics["records_after"]).cast("bigint").alias("records_after"), "low",
        F.greatest(F.col("low") - 10, F.lit(0)).alias("not_listed"))


@query("stamped_rows", """select o_orderkey, o_orderstatus, timestamp '2026-02-10 10:25:25' as processed_at
from orders""")
def stamped(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return stamp(orders, "processed_at", F.lit("2026-02-10 10:25:25").cast("timestamp_ntz"))


# Per user the last purchase value, the last error value and the last kind of event.
_ITEM = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("purchase", T.DoubleType()),
    T.StructField("error", T.DoubleType()), T.StructField("kind", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("event_id", T.LongType())])
_STREAMED = """items as (select user_id, case when event_type = 'purchase' then value end as purchase,
  case when event_type = 'error' then value end as error, event_type as kind, ts, event_id from events),
base as (select c_custkey as user_id, cast(null as double) as purchase, c_acctbal as error, c_mktsegment as kind
  from customer),
folded as (select user_id, last(purchase order by ts, event_id) filter (where purchase is not null) as purchase,
  last(error order by ts, event_id) filter (where error is not null) as error,
  last(kind order by ts, event_id) filter (where kind is not null) as kind, count(*) as n from items group by user_id)"""


def _base(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(None).cast("double").alias("purchase"),
        F.col("c_acctbal").alias("error"), F.col("c_mktsegment").alias("kind"))


def _kinds(batch):
    kind = F.col("event_type")
    return batch.select(
        "user_id", F.when(kind == "purchase", F.col("value")).alias("purchase"),
        F.when(kind == "error", F.col("value")).alias("error"), kind.alias("kind"), "ts", "event_id")


def _streamed(spark, sf):
    """The events table split into files and streamed a few at a time."""
    events = table(spark, sf, "events")
    folder = scratch_path(spark, "arrivals")
    events.repartitionByRange(6, "event_id").write.parquet(folder)
    log = ChangeLog(spark, scratch_path(spark, "changes"), _ITEM, "user_id", ["ts", "event_id"], by_arrival=False)

    source = read_stream(spark, folder, events.schema, maxFilesPerTrigger="2")
    stream_ingest(source, log, _kinds, scratch_path(spark, "stream")).awaitTermination()
    return log


@query("stream_upsert", f"""with {_STREAMED}
select user_id, coalesce(f.purchase, b.purchase) as purchase, coalesce(f.error, b.error) as error,
  coalesce(f.kind, b.kind) as kind from base b full outer join folded f using (user_id)""")
def stream_upsert(spark, sf):
    return _streamed(spark, sf).current(_base(spark, sf))


@query("stream_upsert_stats", f"""with {_STREAMED}, m as (select n, user_id in (select user_id from base) as known from folded)
select cast(sum(n) as bigint) as processed, count(*) filter (where not known) as inserted,
  cast(sum(case when known then n else n - 1 end) as bigint) as updated, cast(100 as double) as success_rate from m""")
def stream_stats(spark, sf):
    return _streamed(spark, sf).stats(_base(spark, sf))


@query("stream_two_runs", f"""with {_STREAMED}
select user_id, coalesce(f.purchase, b.purchase) as purchase, coalesce(f.error, b.error) as error,
  coalesce(f.kind, b.kind) as kind from base b full outer join folded f using (user_id)""")
def two_runs(spark, sf):
    """Files that arrive between two runs of a stream; then the log is compacted."""
    events = table(spark, sf, "events")
    folder, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    log = ChangeLog(spark, scratch_path(spark, "changes"), _ITEM, "user_id", ["ts", "event_id"], by_arrival=False)
    even = F.pmod("event_id", F.lit(2)).eqNullSafe(0)
    for arrived in (events.where(even), events.where(~even)):
        arrived.write.mode("append").parquet(folder)
        source = read_stream(spark, folder, events.schema, maxFilesPerTrigger="1")
        stream_ingest(source, log, _kinds, checkpoint).awaitTermination()
    log.compact()
    return log.current(_base(spark, sf))


@query("stream_levels", f"""with {_STREAMED}
select user_id, coalesce(f.purchase, b.purchase) as purchase, coalesce(f.error, b.error) as error,
  coalesce(f.kind, b.kind) as kind from base b full outer join folded f using (user_id)""")
def stream_levels(spark, sf):
    """A log whose levels are folded while the stream runs."""
    events = table(spark, sf, "events")
    folder = scratch_path(spark, "arrivals")
    events.repartitionByRange(8, "event_id").write.parquet(folder)
    log = ChangeLog(spark, scratch_path(spark, "changes"), _ITEM, "user_id", ["ts", "event_id"], by_arrival=False)
    source = read_stream(spark, folder, events.schema, maxFilesPerTrigger="1")
    stream_ingest(source, log, _kinds, scratch_path(spark, "stream"), fan=2).awaitTermination()
    return log.current(_base(spark, sf))


_EVENT_ITEM = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("event_id", T.LongType())])


@query("stream_rejects", """select event_id, event_type, 'event_type: longer than 5' as reject_reason from events
where length(event_type) > 5""")
def stream_rejects(spark, sf):
    """Rows that the table refuses, while the others are stored and the run goes on."""
    events = table(spark, sf, "events")
    folder, rules = scratch_path(spark, "arrivals"), TableRules(T.StructType([
        col("event_id", T.LongType(), nullable=False), text("event_type", 5)]))
    events.repartitionByRange(4, "event_id").write.parquet(folder)
    log = ChangeLog(spark, scratch_path(spark, "changes"), _EVENT_ITEM, "user_id", ["event_id"])
    source = read_stream(spark, folder, events.schema, maxFilesPerTrigger="1")
    stream_ingest(source, log, lambda df: df, scratch_path(spark, "stream"), rules).awaitTermination()
    return log.rejects(rules).select(F.col("event_id").cast("bigint"), "event_type", "reject_reason")


@query("stream_counters", """select count(*) as total_processed, count(*) as cleaned_ints,
  count(*) filter (where event_type is null or event_type = '') as validation_errors from events""")
def stream_counters(spark, sf):
    """Validation counters of all batches of a run."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("title"), F.lit("1").alias("price"), F.lit("u").alias("url"),
        F.col("event_id").cast("string").alias("rating"))
    folder = scratch_path(spark, "arrivals")
    events.write.parquet(folder)
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("rating", T.LongType())])
    log = ChangeLog(spark, scratch_path(spark, "changes"), schema, "url", ["rating"])
    source = read_stream(spark, folder, events.schema)
    at = F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")
    stream_ingest(source, log, lambda df: validate_items(df, at), scratch_path(spark, "stream")).awaitTermination()
    return log.counters().select("total_processed", "cleaned_ints", "validation_errors")


@query("init_mart", """select 'supplier' as table_name, count(*) as before, count(*) as after from supplier
union all select 'part', 0, 0""")
def init_mart(spark, sf):
    """Creating tables leaves a filled one alone."""
    rules = {n: TableRules(table(spark, sf, n).schema) for n in ("part", "supplier")}
    specs = {n: TableSpec(scratch_path(spark, n), schema=r.schema) for n, r in rules.items()}
    specs["dim_ratings"] = TableSpec(scratch_path(spark, "ratings"))
    append(table(spark, sf, "supplier"), specs["supplier"])
    before = read_table(spark, specs["supplier"]).agg(F.count("*").alias("before"))
    init_tables(spark, specs, rules)
    counts = [read_table(spark, specs[n]).agg(F.count("*").alias("after")).withColumn("table_name", F.lit(n))
              for n in ("supplier", "part")]
    held = before.withColumn("table_name", F.lit("supplier"))
    return counts[0].unionByName(counts[1]).join(held, "table_name", "left").select(
        "table_name", F.coalesce("before", F.lit(0)).cast("bigint").alias("before"), "after")


@query("batch_equals_stream", f"""with {_STREAMED}
select user_id, coalesce(f.purchase, b.purchase) as purchase, coalesce(f.error, b.error) as error,
  coalesce(f.kind, b.kind) as kind from base b full outer join folded f using (user_id)""")
def batch_upsert(spark, sf):
    kind = F.col("event_type")
    updates = table(spark, sf, "events").select(
        "user_id", F.when(kind == "purchase", F.col("value")).alias("purchase"),
        F.when(kind == "error", F.col("value")).alias("error"), kind.alias("kind"), "ts", "event_id")
    return upsert(_base(spark, sf), updates, "user_id", ["ts", "event_id"])
