"""Queries over the given tables, each beside the SQL that states its result.

Importing the modules fills ``REGISTRY``; the SQL is written for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catalog.scratch import with_scratch


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a callable (spark, sf_dir) under ``name`` with its SQL."""
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(with_scratch(fn), sql)
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> dict[str, Entry]:
    from catalog import facts, feed, items, loads, logs, merges, pages, rules, texts  # noqa: F401

    return REGISTRY
