"""What the operators share: reading tables, staged expressions, scratch tables and label folds."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martkit.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that go to a worker at once, where its memory counts.
TEXT_ROWS = 1_000


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What runs inside passes batches of so many rows at most to its workers: executor and worker hold one of each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, whatever executors are lost later.

    With ``rows``, workers get batches of so many rows at most.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is None:
        df.write.parquet(path)
    else:
        with batches_of(df.sparkSession, rows):
            df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times; keeps Catalyst from copying a costly expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def texts(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """Only the columns needed, with a null text read as an empty one."""
    return docs.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents (doc_id, text, y), chosen by a hash of the id.

    Only this many rows of ``labels`` are kept, so the broadcast has a fixed bound;
    ties of the hash are broken by the id, so the choice is the same each run.
    """
    chosen = (labels.select("doc_id", F.col(f"`{label}`").cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & keep)
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(label)), "doc_id").limit(rows))
    return texts(docs, "doc_id").join(F.broadcast(chosen), "doc_id")


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """What a worker no longer uses goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library; others return memory by themselves
    if trim:
        trim(0)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function of a task, after which its worker gives memory back: Spark keeps workers for the next stage."""
    def task(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()
    return task


class Shared:
    """A value of bounded size, sent to each executor once."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._sent.value)
