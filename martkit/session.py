"""Spark settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Adaptive execution is what sizes joins, merges small partitions and splits
# skewed ones at run time; the zone keeps timestamps equal on every machine.  HotSpot does not
# compile methods above 8,000 bytes, so wide projections are generated in parts instead.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: Sizes of partitions and splits, and the size that a block of a shuffle should keep above.
SMALLEST, LARGEST, BLOCK = 128 << 20, 4 << 30, 128 << 10


def sized_for(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a job that shuffles this much.

    With splits and partitions of one size p, n bytes make (n / p) squared blocks of p * p / n
    bytes.  So p grows as the root of the data, from 128 MiB to 4 GiB, which a task sorts with
    spilling: blocks stay above 100 KiB up to 100 TB and more.  At that size a push-based or
    remote shuffle service, which merges the blocks of a partition, is expected all the same.
    Adaptive execution merges partitions that turn out small.
    """
    size = min(LARGEST, max(SMALLEST, int((shuffle_bytes * BLOCK) ** 0.5)))
    return {"spark.sql.shuffle.partitions": str(max(200, -(-shuffle_bytes // size))),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
            "spark.sql.files.maxPartitionBytes": str(size)}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_CHOSEN: dict[str, str] = {}


def use_scratch(spark: SparkSession, path: str) -> None:
    """A shared folder for a session that was started without ``spark.checkpoint.dir``."""
    _CHOSEN[spark.sparkContext.applicationId] = path


def scratch_is_set(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.applicationId in _CHOSEN)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else what ``use_scratch`` set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _CHOSEN.get(spark.sparkContext.applicationId)
    if not root:
        raise ValueError("set spark.checkpoint.dir, or call use_scratch, with a folder every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder; never one used before."""
    return f"{scratch_root(spark)}/martkit/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result to shared storage and read it back.

    Cuts the lineage in a way that outlives executors, computes the input once
    for several readers, and lets each reader prune columns, push filters and
    see real sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, by one listing; none where there is no such folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(hadoop)) if files.exists(hadoop) else []


def local_frame(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """A few rows of the driver's own, planned as a local table instead of a job."""
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), to_arrow_schema(schema)), schema)
