"""Tables, dimensions with a default, and page corpora."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from martkit.schemas import DIM_RATINGS, RATING_ROWS
from martkit.session import local_frame


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives.

    ``format`` is parquet, json, csv, orc, jdbc or any other Spark source; for
    "table" the path is a catalog name.  A JDBC table is read by one task unless
    the options give partitionColumn, lowerBound, upperBound and numPartitions.
    """

    path: str | None = None
    format: str = "parquet"
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)


PARALLEL_JDBC = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_spec(url: str, table: str, user: str, password: str, driver: str,
              split: tuple[str, int | str, int | str, int] | None = None, **options: str) -> TableSpec:
    """A JDBC table; ``split`` is (column, lower, upper, tasks) for a parallel read."""
    opts = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver, **options}
    if split:
        opts |= dict(zip(PARALLEL_JDBC, map(str, split), strict=True))
    return TableSpec(format="jdbc", options=opts)


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    if spec.format == "table":
        return spark.read.options(**spec.options).table(spec.path)
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(spec.path) if spec.path else reader.load()


# The error conditions of Spark that mean "there is no such table".
ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def is_absent(error: AnalysisException) -> bool:
    """Whether an error says that a table does not exist, as opposed to any other trouble."""
    return (error.getCondition() or "").split(".")[0] in ABSENT


def read_or_default(spark: SparkSession, spec: TableSpec, default: DataFrame) -> DataFrame:
    """The table, or ``default`` where it does not exist or has no rows.

    Only a missing table counts as absent; any other failure is raised.
    """
    try:
        df = read_table(spark, spec)
    except AnalysisException as e:
        if not is_absent(e):
            raise
        return default
    return default if df.isEmpty() else df


def inline_dimension(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A constant dimension; fields after the given values are NULL."""
    return local_frame(spark, [dict(zip(schema.names, r)) for r in rows], schema)


def default_ratings(spark: SparkSession) -> DataFrame:
    return inline_dimension(spark, RATING_ROWS, DIM_RATINGS)


def load_readback(spark: SparkSession, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame | Exception]:
    """Every table opened again after a load; a table that cannot be read maps to its error."""
    out: dict[str, DataFrame | Exception] = {}
    for name, spec in specs.items():
        try:
            out[name] = read_table(spark, spec)
        except AnalysisException as e:
            out[name] = e
    return out


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", tasks: int | None = None) -> DataFrame:
    """A page corpus as (page_id, url, html).

    A file of one row group is one task, however long its pages take to read: ``tasks``
    deals the pages out first.
    """
    pages = spark.read.format(fmt).load(path).select("page_id", "url", "html")
    return pages.repartition(tasks) if tasks else pages
