"""Appending, full refresh, seeding and run records.

A mart is a folder of complete versions plus an append-only list of the versions
that were finished.  Readers follow the list, so a refresh that dies half-way
leaves the previous version in place, and no table is ever deleted before its
successor is whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martkit.operators.clean import stamp
from martkit.operators.merge import new_rows, upsert
from martkit.schemas import MART_RULES, RUN_METRICS, TableRules
from martkit.session import local_frame
from martkit.sources.readers import TableSpec, default_ratings, is_absent, read_table

_VERSIONS = T.StructType([
    T.StructField("version", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType())),
    T.StructField("finished_at", T.TimestampType())])


def append(df: DataFrame, spec: TableSpec) -> None:
    """Append to a table; JDBC takes its url, dbtable and login from the options."""
    _write(df, spec, "append")


def overwrite(df: DataFrame, spec: TableSpec) -> None:
    """Replace a table's rows; a JDBC table keeps its definition and is truncated."""
    _write(df, spec, "overwrite")


def _write(df: DataFrame, spec: TableSpec, mode: str) -> None:
    options = dict(spec.options)
    if spec.format == "jdbc" and mode == "overwrite":
        options.setdefault("truncate", "true")
    if spec.format == "table":
        df.write.mode(mode).options(**options).saveAsTable(spec.path)
    else:
        writer = df.write.mode(mode).format(spec.format).options(**options)
        writer.save(spec.path) if spec.path else writer.save()


# What a conditional load reports.
LOADED, SKIPPED, LOADED_UNCHECKED = "loaded", "skipped (already has data)", "loaded (fallback)"


def load_if_empty(df: DataFrame, spec: TableSpec) -> str:
    """Write only into a table without rows; says what was done."""
    try:
        existing = read_table(df.sparkSession, spec)
    except AnalysisException as e:
        if not is_absent(e):
            raise
        append(df, spec)
        return LOADED_UNCHECKED
    if not existing.isEmpty():
        return SKIPPED
    append(df, spec)
    return LOADED


def column_types(schema: T.StructType) -> str:
    """Column types for a JDBC table that Spark creates, with lengths and precision.

    Goes into the ``createTableColumnTypes`` option.
    """
    def one(f: T.StructField) -> str:
        if "max_length" in f.metadata:
            return f"{f.name} VARCHAR({f.metadata['max_length']})"
        return f"{f.name} {f.dataType.simpleString().upper()}"
    fields = [f for f in schema if "max_length" in f.metadata or isinstance(f.dataType, T.DecimalType)]
    return ", ".join(map(one, fields))


def init_tables(spark: SparkSession, specs: Mapping[str, TableSpec], rules: Mapping[str, TableRules] = MART_RULES,
                drop_existing: bool = False) -> list[str]:
    """Create the tables that are missing, or all of them anew; returns what was created.

    A table that is there is never written to unless ``drop_existing``: only an error that says
    "no such table" counts as missing, and creating one fails if it has appeared meanwhile.
    """
    created = []
    # What refers to others goes first when it is emptied.
    for name in reversed(list(rules)):
        spec = specs[name]
        try:
            read_table(spark, spec).schema  # noqa: B018
            exists = True
        except AnalysisException as e:
            if not is_absent(e):
                raise
            exists = False
        if drop_existing or not exists:
            _write(local_frame(spark, [], rules[name].schema), spec, "overwrite" if exists else "errorifexists")
            created.append(name)
    load_if_empty(seed_ratings(spark), specs["dim_ratings"])
    return created[::-1]


def refresh_in_place(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec],
                     rules: Mapping[str, TableRules] = MART_RULES) -> dict[str, str]:
    """Full refresh of tables that are emptied and filled again, such as JDBC tables.

    The fact is emptied before its dimensions and filled after them; the ratings
    are filled only when they are empty.  Give JDBC specs ``cascadeTruncate``
    where foreign keys forbid a plain truncate.  Readers can see the gap: for
    files, ``MartStore.full_refresh`` switches all tables at once.
    """
    order = [n for n in rules if n in tables]
    kept = "dim_ratings"
    for name in reversed(order):
        if name != kept:
            overwrite(tables[name].limit(0), specs[name])
    status = {}
    for name in order:
        if name == kept:
            status[name] = load_if_empty(tables[name], specs[name])
        else:
            append(tables[name], specs[name])
            status[name] = LOADED
    return status


def export_json(df: DataFrame, path: str) -> None:
    """All rows as JSON Lines, NULL fields included."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    df.write.options(ignoreNullFields="false", timestampNTZFormat=micros, timestampFormat=micros + "XXX").json(path)


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METRICS).json(path)


def store_items(items: DataFrame, target: TableSpec, out: TableSpec, key: str, order: Sequence[str],
                clear_before_run: bool = True, defaults: Mapping[str, object] | None = None) -> None:
    """Store a run's items in ``out``: alone, or merged by key into what ``target`` holds.

    ``out`` is another place than ``target``, because a file table cannot be
    replaced while it is read.  Several items of one key become one row either way.
    """
    spark = items.sparkSession
    held = local_frame(spark, [], target.schema) if clear_before_run else read_table(spark, target)
    overwrite(upsert(held, items, key, order, defaults), out)


@dataclass(frozen=True)
class Version:
    """A finished version of a mart and the tables it holds."""

    name: str
    tables: tuple[str, ...]


@dataclass(frozen=True)
class MartStore:
    """A versioned mart below ``root``, which must be shared storage."""

    spark: SparkSession
    root: str
    rules: Mapping[str, TableRules] = field(default_factory=lambda: MART_RULES)

    def latest(self) -> Version | None:
        """The version finished last."""
        try:
            done = self.spark.read.schema(_VERSIONS).json(f"{self.root}/_versions")
        except AnalysisException as e:
            if not is_absent(e):
                raise
            return None
        row = done.agg(F.max_by(F.struct("version", "tables"), F.struct("finished_at", "version")).alias("v")).first()
        return Version(row["v"]["version"], tuple(row["v"]["tables"])) if row["v"] else None

    def spec(self, table: str, version: str | None = None) -> TableSpec:
        if version is None:
            latest = self.latest()
            if latest is None:
                raise LookupError(f"no finished version below {self.root}")
            version = latest.name
        schema = self.rules[table].schema if table in self.rules else None
        return TableSpec(f"{self.root}/{version}/{table}", schema=schema)

    def read(self, table: str, version: str | None = None) -> DataFrame:
        return read_table(self.spark, self.spec(table, version))

    def new_version(self) -> str:
        return f"v-{uuid.uuid4().hex}"

    def write(self, version: str, table: str, df: DataFrame) -> DataFrame:
        """Write one table of a version not yet finished, and read it back."""
        path = f"{self.root}/{version}/{table}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, version: str, tables: Sequence[str]) -> None:
        """Make a version the current one: a single appended row."""
        row = {"version": version, "tables": list(tables), "finished_at": datetime.now(UTC)}
        local_frame(self.spark, [row], _VERSIONS).write.mode("append").json(f"{self.root}/_versions")

    def missing_tables(self) -> list[str]:
        latest = self.latest()
        return [t for t in self.rules if latest is None or t not in latest.tables]

    def init(self, drop_existing: bool = False) -> str:
        """A current version that has every table, empty but for the rating seed.

        An existing complete version is kept unless ``drop_existing``.
        """
        latest = self.latest()
        have = () if latest is None or drop_existing else latest.tables
        if all(t in have for t in self.rules):
            return latest.name
        version = self.new_version()
        for table, rules in self.rules.items():
            df = self.read(table, latest.name) if table in have else local_frame(self.spark, [], rules.schema)
            if table == "dim_ratings":
                seed = seed_ratings(self.spark)
                df = df.unionByName(new_rows(df, seed, "rating_id")) if table in have else seed
            self.write(version, table, df)
        self.finish(version, list(self.rules))
        return version

    def full_refresh(self, tables: Mapping[str, DataFrame]) -> str:
        """Write all tables, dimensions before the fact, then switch to them at once."""
        version = self.new_version()
        for name in sorted(tables, key=list(self.rules).index):
            self.write(version, name, tables[name])
        self.finish(version, list(tables))
        return version


def seed_ratings(spark: SparkSession) -> DataFrame:
    return stamp(default_ratings(spark), "created_at", F.lit(datetime.now(UTC)))


def run_record(spark: SparkSession, row: dict) -> DataFrame:
    return local_frame(spark, [row], RUN_METRICS)
