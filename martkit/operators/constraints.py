"""Table promises as DataFrames of violations: an empty result means a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martkit.operators.clean import loses_value
from martkit.operators.lookup import fk_orphans
from martkit.schemas import TableRules
from martkit.session import local_frame


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row counts."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(
        (F.col("row_count") > 1) | has_null)


def check_unique(df: DataFrame, name: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count as equal."""
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count("*").alias("row_count")).where("row_count > 1")


def check_range(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(name).between(low, high))


def check_not_null(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNull())


def check_length(df: DataFrame, name: str, max_length: int) -> DataFrame:
    return df.where(F.length(name) > max_length)


def check_numeric(df: DataFrame, name: str, precision: int = 10, scale: int = 2) -> DataFrame:
    """Rows whose value does not fit NUMERIC(precision, scale)."""
    return df.where(_no_fit(df, name, precision, scale))


def _no_fit(df: DataFrame, name: str, precision: int, scale: int) -> Column:
    return loses_value(F.col(name), df.schema[name].dataType, T.DecimalType(precision, scale))


def check_foreign_key(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    return fk_orphans(fact, dim, fk, pk)


def missing_members(required: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """Members of ``required`` that are not in ``present``."""
    return required.select(name).join(present.select(name).distinct(), name, "left_anti")


def check_tables_present(spark: SparkSession, required: Iterable[str], present: Iterable[str]) -> DataFrame:
    schema = T.StructType([T.StructField("table_name", T.StringType())])
    names = lambda tables: local_frame(spark, [{"table_name": t} for t in tables], schema)
    return missing_members(names(required), names(present), "table_name")


def check_table(name: str, tables: Mapping[str, DataFrame], rules: TableRules) -> DataFrame:
    """All promises of one table as rows (table_name, rule, violations).

    Row-wise rules share one aggregate over one scan; keys and references add
    one pre-aggregated pass each.
    """
    df = tables[name]
    row_rules = {f"not_null({c})": F.col(c).isNull() for c in rules.not_null}
    row_rules |= {f"length({c})": F.length(c) > n for c, n in rules.lengths.items()}
    row_rules |= {f"range({c})": ~F.col(c).between(*b) for c, b in rules.ranges.items()}
    row_rules |= {
        f"numeric({c})": _no_fit(df, c, p, s)
        for c, (p, s) in rules.decimals.items()}

    found: list[DataFrame] = []
    if row_rules:
        labels = list(row_rules)
        counts = df.agg(*[F.count_if(row_rules[r]).alias(f"_r{i}") for i, r in enumerate(labels)])
        pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_r{i}").alias("violations"))
                          for i, r in enumerate(labels)])
        found.append(counts.select(F.inline(pairs)))
    if rules.primary_key:
        label = f"primary_key({', '.join(rules.primary_key)})"
        found.append(_count(check_primary_key(df, rules.primary_key), label))
    for c in rules.unique:
        found.append(_count(check_unique(df, c), f"unique({c})"))
    for fk in rules.foreign_keys:
        orphans = check_foreign_key(df, tables[fk.table], fk.column, fk.ref_column)
        found.append(_count(orphans, f"foreign_key({fk.column})"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(name).alias("table_name"), "rule", "violations")


def _count(violations: DataFrame, label: str) -> DataFrame:
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(label).alias("rule"), "violations")
