"""Statistics over a request log: the events table in the part of the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.functions.urls import short_key
from martkit.operators.stats import delay_stats, kind_share, latest_values, load_verification, throughput, top_k
from catalog import query, table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("delay_stats", """with per_key as (
  select user_id, count(value) as n, sum(value) as total, arg_max(value, ts) as latest from events group by user_id)
select cast(sum(n) as bigint) as request_count, round(sum(total), 2) as total_delay,
  round(sum(total) / sum(n), 6) as avg_delay, min(latest) as min_delay, max(latest) as max_delay from per_key""")
def delays(spark, sf):
    return delay_stats(table(spark, sf, "events"), "user_id", "value", ["ts", "event_id"]).withColumns({
        "total_delay": F.round("total_delay", 2), "avg_delay": F.round("avg_delay", 6)})


@query("top5_latest", """select user_id, arg_max(value, ts) as value from events group by user_id
order by value desc, user_id limit 5""")
def top5_latest(spark, sf):
    return top_k(latest_values(table(spark, sf, "events"), "user_id", "value", ["ts", "event_id"]), "value", 5, ["user_id"])


@query("page_delay_stats", """with log as (
  select case when length(url) > 50 then split_part(url, '/', -1) else url end as key, page_id, length(html) as size
  from pages), per_key as (select key, count(*) as n, sum(size) as total, arg_max(size, page_id) as latest
  from log group by key)
select cast(sum(n) as bigint) as request_count, cast(sum(total) as bigint) as total_delay,
  round(sum(total) / sum(n), 6) as avg_delay, cast(min(latest) as int) as min_delay,
  cast(max(latest) as int) as max_delay from per_key""")
def page_delays(spark, sf):
    log = table(spark, sf, "pages").select(short_key("url").alias("key"), "page_id", F.length("html").alias("size"))
    return delay_stats(log, "key", "size", "page_id").withColumn("avg_delay", F.round("avg_delay", 6))


@query("kind_share", """select count(*) as total, count(*) filter (where event_type = 'view') as browser_count,
  count(*) filter (where event_type <> 'view') as plain_count,
  round(count(*) filter (where event_type = 'view') * cast(100 as double) / count(*), 1) as browser_percent,
  round(100 - count(*) filter (where event_type = 'view') * cast(100 as double) / count(*), 1) as plain_percent
from events""")
def kinds(spark, sf):
    return kind_share(table(spark, sf, "events"), F.col("event_type") == "view", "browser", "plain")


@query("throughput", """with t as (select count(*) as row_count,
  cast(epoch_us(max(ts)) - epoch_us(min(ts)) as double) / 1000000 as seconds from events)
select row_count, seconds, round(row_count / seconds, 9) as rows_per_second from t""")
def event_rate(spark, sf):
    return throughput(table(spark, sf, "events"), "ts").withColumn(
        "rows_per_second", F.round("rows_per_second", 9))


@query("load_verification", " union all ".join(
    f"select '{t}' as table_name, count(*) as records, case when count(*) > 0 then 'loaded' else 'empty' end as status,"
    f" cast(null as varchar) as error from {t}" for t in TABLES))
def verification(spark, sf):
    return load_verification({t: table(spark, sf, t) for t in TABLES})
