"""Upsert by key that never overwrites a stored value with NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.operators.clean import loses_value, quarantine
from martkit.operators.dedup import dedup_keep_first
from martkit.session import materialize


def reduce_updates(updates: DataFrame, key: str, order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: in every column the last value that is not NULL.

    Also ``_updates``, the number of rows folded.  The fold is an aggregate with
    a partial step, so a hot key is reduced before it is shuffled.
    """
    columns = columns or [c for c in updates.columns if c != key and c not in order]
    # max_by passes over a NULL ordering; a struct is not NULL even if its fields are.
    last = F.struct(*[F.col(o) for o in order])
    folded = [F.max_by(c, F.when(F.col(c).isNotNull(), last)).alias(c) for c in columns]
    return updates.where(F.col(key).isNotNull()).groupBy(key).agg(
        *folded, F.count("*").alias("_updates"))


def upsert(target: DataFrame, updates: DataFrame, key: str, order: Sequence[str],
           defaults: Mapping[str, object] | None = None, few: bool = False) -> DataFrame:
    """The target after the updates: new over old over default, column by column.

    Defaults apply to inserted keys only.  Both sides hold a key once when they
    meet, so the join cannot multiply rows or gather them at one key.

    A value that the target's type cannot hold counts as not sent; ``split_storable`` keeps such
    rows apart beforehand.  Columns that the target lacks, other than those of ``order``, are an error.

    With ``few`` the folded updates are written first, so that Spark knows their
    size and, if it is small, sends them to the target instead of shuffling it.
    """
    shared = shared_columns(target.columns, updates.columns, key, order)
    return merge_folded(target, reduce_updates(updates, key, order, shared), key, shared, defaults, few)


def shared_columns(target: Sequence[str], updates: Sequence[str], key: str, order: Sequence[str]) -> list[str]:
    """The columns that updates may change; those the target lacks are an error."""
    unknown = [c for c in updates if c not in target and c not in order]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    return [c for c in target if c != key and c in updates]


def merge_folded(target: DataFrame, folded: DataFrame, key: str, shared: Sequence[str],
                 defaults: Mapping[str, object] | None = None, few: bool = False) -> DataFrame:
    """The target after updates that ``reduce_updates`` has folded; see ``upsert``."""
    columns = [c for c in target.columns if c != key]
    new = folded.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in shared])
    old = target.select(F.col(key), F.lit(True).alias("_held"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = _join_few(old, new, key) if few else old.join(new, key, "full_outer")

    merged = []
    for c in columns:
        dtype, value = target.schema[c].dataType, F.col(f"_old_{c}")
        if c in shared:
            value = F.coalesce(F.col(f"_new_{c}").try_cast(dtype), value)
        if defaults and c in defaults:
            default = defaults[c] if isinstance(defaults[c], Column) else F.lit(defaults[c])
            value = F.when(F.col("_held") | value.isNotNull(), value).otherwise(default.cast(dtype))
        merged.append(value.alias(c))
    return joined.select(key, *merged).select(*target.columns)


def _join_few(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Full outer join as a left join plus the keys the target lacks.

    The second pass reads only the target's key column.
    """
    new = materialize(new, "updates")
    known = old.select(key).join(new.select(key), key, "left_semi").distinct()
    return old.join(new, key, "left").unionByName(
        new.join(known, key, "left_anti"), allowMissingColumns=True)


def split_storable(updates: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Updates whose values the target's types hold, and the others with their reasons."""
    checks = [F.when(loses_value(F.col(f.name), updates.schema[f.name].dataType, f.dataType),
                     f"{f.name}: not a {f.dataType.simpleString()}")
              for f in target.schema if f.name in updates.columns and updates.schema[f.name].dataType != f.dataType]
    return quarantine(updates, checks)


def upsert_stats(target: DataFrame, updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """processed, inserted, updated and the success share, as one row.

    The first update of an unknown key counts as its insert; the others update it.
    Rows without a key are processed but stored nowhere.
    """
    folded = updates.groupBy(key).agg(F.count("*").alias("_updates"))
    known = target.select(F.col(key).alias("_key"), F.lit(True).alias("_old"))
    n, new = F.col("_updates"), F.col("_old").isNull() & F.col(key).isNotNull()
    per_key = folded.join(known, F.col(key) == F.col("_key"), "left")
    total = per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("processed"),
        F.count_if(new).alias("inserted"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), 0).when(new, n - 1).otherwise(n)),
                   F.lit(0)).alias("updated"))
    done = F.col("inserted") + F.col("updated")
    return total.withColumn("success_rate", F.coalesce(
        F.round(F.try_divide(done, F.col("processed")) * 100, 1), F.lit(0.0)))


def split_updates(updates: DataFrame, target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key the target knows, and rows whose key it does not.

    The target is reduced to its distinct keys before they are shuffled, so a
    key it holds often does not swell one partition; a key that is frequent among
    the updates is split by adaptive execution.
    """
    known = target.select(key).distinct()
    return updates.join(known, key, "left_semi"), updates.join(known, key, "left_anti")


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str,
                     order: Sequence[str] | None = None) -> DataFrame:
    """The target plus those rows whose key it does not hold yet."""
    return target.unionByName(new_rows(target, rows, key, order))


def new_rows(target: DataFrame, rows: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """Those rows whose key the target does not hold: what an append has to write.

    Where ``rows`` may hold a key more than once, ``order`` says which row is first.
    """
    if order:
        rows = dedup_keep_first(rows, key, order)
    return split_updates(rows, target, key)[1].select(*rows.columns)
