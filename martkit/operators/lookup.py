"""Natural key to surrogate key: left joins from a fact to its dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What a dimension's keys and ids may measure to be sent to every executor.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class DimRef:
    """A dimension and how a fact refers to it.

    ``size`` is the measured size in bytes of its keys and ids; see ``measured``.
    """

    df: DataFrame
    fact_key: str
    dim_key: str
    id_name: str
    size: int | None = None


def measured(ref: DimRef) -> DimRef:
    """The reference with its size, from one aggregate over the (finished) dimension."""
    width = F.octet_length(F.col(ref.dim_key).cast("string")) + 16
    return replace(ref, size=ref.df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0])


def _comparable(key: Column, have: T.DataType, other: T.DataType) -> Column:
    """A key in a form that both sides can be compared in without losing a value.

    Numbers widen by themselves; anything else of different types is compared as text.
    """
    same = have == other or (isinstance(have, T.NumericType) and isinstance(other, T.NumericType))
    return key if same else key.cast("string")


def lookup_dimensions(fact: DataFrame, dims: Sequence[DimRef]) -> DataFrame:
    """Add one id column per dimension; unmatched and NULL keys get NULL.

    A dimension measured at no more than ``BROADCAST_BYTES`` is broadcast, and the
    fact is not shuffled at all.  Any other one is left to Spark: adaptive
    execution broadcasts it when its measured size allows, and otherwise joins
    by shuffle and splits the partitions that a hot key swells.  For that case a
    second join column is added: the hash of the key, or of the whole row where
    the key is NULL, so that keyless rows do not gather in one partition.
    """
    out = fact
    for d in dims:
        key = F.col("_dim_key")
        have, want = fact.schema[d.fact_key].dataType, d.df.schema[d.dim_key].dataType
        own = _comparable(F.col(d.fact_key), have, want)
        ref = d.df.select(_comparable(F.col(d.dim_key), want, have).alias("_dim_key"), F.col(d.id_name))
        if d.size is not None and d.size <= BROADCAST_BYTES:
            out = out.join(F.broadcast(ref), own == key, "left")
        else:
            # Hashes of equal keys are equal in one type only, so both sides are hashed as text.
            spread = F.when(F.col(d.fact_key).isNull(), F.xxhash64(*out.columns)).otherwise(
                F.xxhash64(_hashable(F.col(d.fact_key), have, want)))
            out = out.withColumn("_spread", spread).join(
                ref.withColumn("_dim_spread", F.xxhash64(_hashable(key, have, want))),
                (own == key) & (F.col("_spread") == F.col("_dim_spread")),
                "left").drop("_spread", "_dim_spread")
        out = out.drop("_dim_key")
    return out


def _hashable(key: Column, have: T.DataType, other: T.DataType) -> Column:
    """A key in one type for both sides: whole numbers as decimals, other numbers as doubles."""
    if have == other or not (isinstance(have, T.NumericType) and isinstance(other, T.NumericType)):
        return key if have == other else key.cast("string")
    whole = all(isinstance(t, T.IntegralType) for t in (have, other))
    return key.cast("decimal(38,0)" if whole else "double")


def fk_orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a partner, with the number of fact rows that hold each.

    Both sides are reduced to distinct keys before the join, so neither the
    fact's size nor a hot key reaches it.
    """
    used = fact.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("row_count"))
    return used.join(_keys(dim, pk), F.col(fk) == F.col("_pk"), "left_anti")


def orphan_rows(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """The fact rows themselves whose foreign key has no partner.

    The orphaned keys come first, from distinct keys alone.  They are few where the
    references are kept, and adaptive execution then sends them to the fact, whose wide
    rows are read a second time but not shuffled; many of them are joined by shuffle.
    """
    keys = fk_orphans(fact.select(fk), dim, fk, pk).select(F.col(fk).alias("_fk"))
    return fact.join(keys, F.col(fk) == F.col("_fk"), "left_semi")


def _keys(dim: DataFrame, pk: str) -> DataFrame:
    return dim.select(F.col(pk).alias("_pk")).distinct()
