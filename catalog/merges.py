"""Upserts: many updates per key folded into a keyed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.merge import insert_if_absent, reduce_updates, split_storable, split_updates, upsert, upsert_stats
from martkit.session import scratch_path
from martkit.sources.buckets import BucketedTable
from catalog import query, table

ORDER = ["o_orderdate", "o_orderkey"]
DEFAULTS = {"s_nationkey": -1}
# Orders play the updates of a supplier table: fields are absent at fixed statuses,
# and the nation is never sent, so that inserts show the default.
UPDATES = """select o_custkey as s_suppkey,
  case when o_orderstatus = 'F' then null else o_orderpriority end as s_name,
  cast(null as int) as s_nationkey,
  case when o_orderstatus = 'P' then null else o_totalprice end as s_acctbal,
  o_orderdate, o_orderkey from orders"""
_LAST = "last({0} order by o_orderdate, o_orderkey) filter (where {0} is not null) as {0}"
FOLDED = f"""updates as ({UPDATES}), folded as (
  select s_suppkey, {_LAST.format('s_name')}, {_LAST.format('s_nationkey')}, {_LAST.format('s_acctbal')},
    count(*) as n from updates group by s_suppkey)"""


def supplier_updates(spark, sf):
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_custkey").alias("s_suppkey"),
        F.when(status != "F", F.col("o_orderpriority")).alias("s_name"),
        F.lit(None).cast("int").alias("s_nationkey"),
        F.when(status != "P", F.col("o_totalprice")).alias("s_acctbal"),
        "o_orderdate", "o_orderkey")


@query("reduce_updates", f"with {FOLDED} select s_suppkey, s_name, s_nationkey, s_acctbal, n as updates from folded")
def reduced(spark, sf):
    return reduce_updates(supplier_updates(spark, sf), "s_suppkey", ORDER).withColumnRenamed("_updates", "updates")


@query("upsert_merge", f"""with {FOLDED}
select s_suppkey, coalesce(f.s_name, s.s_name) as s_name,
  case when s.s_nationkey is null then coalesce(f.s_nationkey, -1) else coalesce(f.s_nationkey, s.s_nationkey) end
    as s_nationkey,
  coalesce(f.s_acctbal, s.s_acctbal) as s_acctbal
from supplier s full outer join folded f using (s_suppkey)""")
def upsert_merge(spark, sf):
    return upsert(table(spark, sf, "supplier"), supplier_updates(spark, sf), "s_suppkey", ORDER, DEFAULTS)


_MERGED = f"""with {FOLDED}
select s_suppkey, coalesce(f.s_name, s.s_name) as s_name, coalesce(f.s_nationkey, s.s_nationkey, -1) as s_nationkey,
  coalesce(f.s_acctbal, s.s_acctbal) as s_acctbal
from supplier s full outer join folded f using (s_suppkey)"""


@query("upsert_few", _MERGED)
def upsert_few(spark, sf):
    return upsert(table(spark, sf, "supplier"), supplier_updates(spark, sf), "s_suppkey", ORDER, DEFAULTS, few=True)


@query("upsert_buckets", _MERGED)
def upsert_buckets(spark, sf):
    """The same result from a table in hash buckets, in two loads."""
    suppliers, updates = table(spark, sf, "supplier"), supplier_updates(spark, sf)
    stored = BucketedTable(spark, scratch_path(spark, "buckets"), suppliers.schema, "s_suppkey")
    stored.replace(suppliers, 16)
    # Every key is in one of the two loads, so that each of them folds all of a key's updates.
    early = F.pmod("s_suppkey", F.lit(3)).eqNullSafe(0)
    for part in (updates.where(early), updates.where(~early)):
        stored.upsert(part, ORDER, DEFAULTS)
    return stored.read()


@query("upsert_quarantine", """with updates as (select c_custkey, c_name, case when c_custkey % 3 = 0 then c_name
  when c_custkey % 3 = 1 then '99999999999' else cast(c_nationkey as varchar) end as s_nationkey from customer),
good as (select * from updates where c_custkey % 3 = 2)
select coalesce(s.s_suppkey, g.c_custkey) as key, coalesce(cast(g.s_nationkey as int), s.s_nationkey) as nation,
  'stored' as outcome from supplier s full outer join good g on s.s_suppkey = g.c_custkey
union all select c_custkey, null, 's_nationkey: not a int' from updates where c_custkey % 3 <> 2""")
def upsert_quarantine(spark, sf):
    """Updates that the target's types cannot hold are kept apart; the others are merged."""
    suppliers = table(spark, sf, "supplier")
    kind = F.col("c_custkey") % 3
    updates = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.when(kind == 0, F.col("c_name")).when(kind == 1, "99999999999").otherwise(
            F.col("c_nationkey").cast("string")).alias("s_nationkey"))
    good, refused = split_storable(updates, suppliers)
    merged = upsert(suppliers, good, "s_suppkey", ["s_suppkey"])
    return merged.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.lit("stored").alias(
        "outcome")).unionByName(refused.select(
            F.col("s_suppkey").alias("key"), F.lit(None).cast("int").alias("nation"), F.col("reject_reason").alias("outcome")))


@query("upsert_stats", f"""with {FOLDED}, m as (
  select n, s_suppkey in (select s_suppkey from supplier) as known from folded)
select cast(sum(n) as bigint) as processed, count(*) filter (where not known) as inserted,
  cast(sum(case when known then n else n - 1 end) as bigint) as updated, cast(100 as double) as success_rate from m""")
def upsert_counts(spark, sf):
    return upsert_stats(table(spark, sf, "supplier"), supplier_updates(spark, sf), "s_suppkey", ORDER)


@query("update_vs_insert_keys", """select c_custkey, 'update' as action from customer
where c_custkey in (select user_id from events) union all
select c_custkey, 'insert' from customer where c_custkey not in (select user_id from events)""")
def update_vs_insert(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    known = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    old, new = split_updates(customers, known, "c_custkey")
    return old.withColumn("action", F.lit("update")).unionByName(new.withColumn("action", F.lit("insert")))


@query("insert_if_absent", """select cast(n_nationkey as bigint) as n_nationkey, n_name, n_regionkey from nation
union all select s_suppkey, s_name, s_nationkey from supplier
where s_suppkey not in (select n_nationkey from nation)""")
def absent_rows(spark, sf):
    nation = table(spark, sf, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("bigint"))
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("n_nationkey"), F.col("s_name").alias("n_name"),
        F.col("s_nationkey").alias("n_regionkey"))
    return insert_if_absent(nation, rows, "n_nationkey")
