"""Distinct values and dense surrogate keys in hash order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from martkit.operators.clean import non_blank
from martkit.session import materialize


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct non-blank values of one column."""
    return non_blank(df.select(name), name).distinct()


#: Values that one task ranks: 16-byte hashes, so some tens of megabytes.
RANGE_ROWS = 1 << 20
#: Digits of a range that are counted together in the first of two levels.
FIRST_DIGITS = 3


def range_digits(values: int, range_rows: int = RANGE_ROWS) -> int:
    """Leading hex digits that cut so many hashes into ranges of about ``range_rows`` at most."""
    return max(1, math.ceil(math.log(max(values, 1) / range_rows, 16))) if values > range_rows else 1


def surrogate_keys(values: DataFrame, name: str, id_name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Ids 1..N in the order of md5(value), equal to a dense rank over all values.

    A rank over the whole table would sort it in one task.  The leading hex digits of the hash
    cut it into ranges instead, as many as the number of values asks for: md5 spreads evenly, so
    the ranges are alike in size, and a range's own rank plus the number of ranks in the ranges
    before it is the global rank.  The range totals are added up in two levels, so at most 4,096
    of them, or those of one group, meet in one task.  Only hashes are sorted; the values wait in
    a written table and are joined to their ids by the hash.  The ids depend on the values alone,
    so a task that runs again gives the same ids.
    """
    hashed = materialize(values.select(name, F.md5(name).alias("_hash")), "values")
    ids = hash_ranks(hashed.select("_hash"), range_digits(hashed.count(), range_rows), id_name)
    return hashed.join(ids, "_hash").select(id_name, name)


def hash_ranks(hashes: DataFrame, digits: int, id_name: str) -> DataFrame:
    """The dense rank of every ``_hash``, from ranks within ranges of ``digits`` leading digits."""
    ranged = hashes.withColumn("_range", F.substring("_hash", 1, digits))
    local = ranged.withColumn("_rank", F.dense_rank().over(Window.partitionBy("_range").orderBy("_hash")))
    totals = local.groupBy("_range").agg(F.max("_rank").cast("bigint").alias("_n")).withColumn(
        "_group", F.substring("_range", 1, FIRST_DIGITS))
    within = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy("_group").agg(F.sum("_n").alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before"))
    offsets = totals.select("_range", "_group", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_inside")).join(
        F.broadcast(groups), "_group").select(F.col("_range").alias("_at"), (F.col("_before") + F.col("_inside")).alias("_offset"))
    # Null-safe equality adds no filter to either side: both then read one and the same exchange.
    return local.join(offsets, F.col("_range").eqNullSafe(F.col("_at"))).select(
        "_hash", (F.col("_offset") + F.col("_rank")).alias(id_name)).distinct()


def build_dimension(df: DataFrame, name: str, id_name: str) -> DataFrame:
    """Dimension (id, value) of the non-blank values of a column."""
    return surrogate_keys(distinct_values(df, name), name, id_name)
