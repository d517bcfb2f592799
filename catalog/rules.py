"""Constraint checks and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from martkit.operators.clean import enforce_schema, quarantine, storage_problems
from martkit.operators.constraints import (
    check_length, check_not_null, check_numeric, check_primary_key, check_range, check_table, check_unique,
    missing_members)
from martkit.operators.dedup import first_places, later_duplicates
from martkit.schemas import ForeignKey, TableRules, col, text
from catalog import query, table
from catalog.feed import RAW, raw_items


@query("check_pk", """select l_orderkey, l_linenumber, count(*) as row_count from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""")
def pk(spark, sf):
    return check_primary_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_pk_nulls", f"""with {RAW}
select upc, count(*) as row_count from raw group by upc having count(*) > 1 or upc is null""")
def pk_nulls(spark, sf):
    return check_primary_key(raw_items(spark, sf), ["upc"])


@query("check_unique", f"""with {RAW}
select upc, count(*) as row_count from raw where upc is not null group by upc having count(*) > 1""")
def unique(spark, sf):
    return check_unique(raw_items(spark, sf), "upc")


@query("check_range", f"with {RAW} select url, rating from raw where not (rating between 0 and 5)")
def ranges(spark, sf):
    return check_range(raw_items(spark, sf), "rating", 0, 5).select("url", "rating")


@query("check_not_null", f"with {RAW} select url, title from raw where title is null")
def not_null(spark, sf):
    return check_not_null(raw_items(spark, sf), "title").select("url", "title")


@query("check_length", "select doc_id, n_chars from documents where length(text) > 500")
def lengths(spark, sf):
    return check_length(table(spark, sf, "documents"), "text", 500).select("doc_id", "n_chars")


@query("check_numeric", """select o_orderkey, o_totalprice * 1000 as scaled from orders
where o_totalprice * 1000 >= 99999999.995""")
def numeric(spark, sf):
    orders = table(spark, sf, "orders").withColumn("scaled", F.col("o_totalprice") * 1000)
    return check_numeric(orders, "scaled").select("o_orderkey", "scaled")


@query("missing_members", """select o_orderkey as key from orders where o_orderkey not in
(select l_orderkey from lineitem)""")
def missing(spark, sf):
    return missing_members(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("key")),
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key")), "key")


# What the customer and events tables would promise as dimension and fact.
EVENT_RULES = TableRules(
    T.StructType([
        col("event_id", T.LongType(), nullable=False), text("event_type", 5, nullable=False),
        col("value", T.DecimalType(4, 2)), text("props", 8)]),
    primary_key=("event_id",), unique=("user_id",), ranges={"value": (0, 100)},
    foreign_keys=(ForeignKey("event_id", "labels", "doc_id"),))


@query("check_table", """
select 'events' as table_name, 'not_null(event_id)' as rule, count(*) filter (where event_id is null) as violations
from events union all
select 'events', 'not_null(event_type)', count(*) filter (where event_type is null) from events union all
select 'events', 'length(event_type)', count(*) filter (where length(event_type) > 5) from events union all
select 'events', 'length(props)', count(*) filter (where length(props) > 8) from events union all
select 'events', 'range(value)', count(*) filter (where not (value between 0 and 100)) from events union all
select 'events', 'numeric(value)', count(*) filter (where value >= 99.995) from events union all
select 'events', 'primary_key(event_id)', count(*) from (select event_id from events group by 1 having count(*) > 1)
union all
select 'events', 'unique(user_id)', count(*) from (select user_id from events group by 1 having count(*) > 1) union all
select 'events', 'foreign_key(event_id)', count(*) from (select distinct event_id from events
  where event_id not in (select doc_id from labels))""")
def all_rules(spark, sf):
    tables = {"events": table(spark, sf, "events"), "labels": table(spark, sf, "labels")}
    return check_table("events", tables, EVENT_RULES)


ITEM_RULES = TableRules(
    T.StructType([
        text("upc", 50, nullable=False), text("title", 12, nullable=False), col("price", T.DecimalType(7, 2)),
        col("rating", T.IntegerType()), text("url", 500)]),
    ranges={"rating": (0, 5)})
_REASON = """concat_ws('; ', case when upc is null then 'upc: is null' end,
  case when length(upc) > 50 then 'upc: longer than 50' end,
  case when title is null then 'title: is null' end,
  case when length(title) > 12 then 'title: longer than 12' end,
  case when price >= 99999.995 then 'price: not a decimal(7,2)' end,
  case when not (rating between 0 and 5) then 'rating: out of range' end)"""


@query("quarantine_rejects", f"""with {RAW}, tagged as (select url, {_REASON} as reject_reason from raw)
select url, reject_reason from tagged where reject_reason <> ''""")
def quarantine_rejects(spark, sf):
    raw = raw_items(spark, sf)
    return quarantine(raw, storage_problems(raw, ITEM_RULES))[1].select("url", "reject_reason")


@query("quarantine_stored", f"""with {RAW}, tagged as (select *, {_REASON} as reject_reason from raw)
select upc, title, cast(price as double) as price, rating, url from tagged where reject_reason = ''""")
def quarantine_stored(spark, sf):
    raw = raw_items(spark, sf)
    good, _ = quarantine(raw, storage_problems(raw, ITEM_RULES))
    return enforce_schema(good, ITEM_RULES.schema).withColumn("price", F.col("price").cast("double"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@query("quarantine_split", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  case when rn = 1 then 'stored' else 'rejected' end as outcome
from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey)
  as rn from lineitem)""")
def quarantine_split(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER)
    keys = ["l_orderkey", "l_linenumber"]
    firsts = first_places(lines, keys, _LINE_ORDER)
    stored = firsts.drop("_ties").withColumn("outcome", F.lit("stored"))
    rejected = later_duplicates(lines, keys, _LINE_ORDER, firsts).withColumn("outcome", F.lit("rejected"))
    return stored.unionByName(rejected)
