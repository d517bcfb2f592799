"""A keyed table in hash buckets, of which an upsert rewrites only those that got updates.

Every key belongs to one bucket by its hash.  A write puts the buckets it changes into a new folder
(``data/<write>/bucket=N``); a version says which folder holds each bucket now, and the table
switches to it by one appended row.  Files of untouched buckets stay as they are and are not
read either, so an upsert costs its own rows and the buckets they fall into, not the table.

A table has one writer at a time and any number of readers; a write that dies half-way leaves the last version
as it was.  Nothing is deleted: folders that no version in use names may be expired by age.  What
the driver holds is one row per bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martkit.operators.merge import merge_folded, reduce_updates, shared_columns
from martkit.session import local_frame, materialize
from martkit.sources.readers import is_absent

_SWITCH = T.StructType([T.StructField("version", T.StringType()), T.StructField("buckets", T.IntegerType()),
                        T.StructField("finished_at", T.TimestampType())])
_PLACES = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType())])


def buckets_for(table_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """How many buckets a table of this size asks for: one is what a task reads, sorts and writes at once."""
    return max(1, -(-table_bytes // bucket_bytes))


@dataclass(frozen=True)
class BucketedTable:
    """A table below ``root`` (shared storage) with a unique ``key`` and a fixed schema."""

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str

    def _current(self) -> tuple[str, int] | None:
        """Name and number of buckets of the version finished last."""
        try:
            done = self.spark.read.schema(_SWITCH).json(f"{self.root}/_versions")
        except AnalysisException as e:
            if not is_absent(e):
                raise
            return None
        row = done.agg(F.max_by(F.struct("version", "buckets"), F.struct("finished_at", "version")).alias("v")).first()["v"]
        return (row["version"], row["buckets"]) if row else None

    def _required(self) -> tuple[str, int]:
        current = self._current()
        if current is None:
            raise LookupError(f"no table below {self.root}: replace() makes the first version")
        return current

    def places(self) -> dict[int, str]:
        """The folder of every bucket that holds rows."""
        version, _ = self._required()
        rows = self.spark.read.schema(_PLACES).json(f"{self.root}/_places/{version}").collect()
        return {r["bucket"]: r["folder"] for r in rows}

    def _read(self, places: Mapping[int, str]) -> DataFrame:
        if not places:
            return local_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self.root}/data/{folder}/bucket={b}" for b, folder in sorted(places.items())])

    def read(self) -> DataFrame:
        """All rows of the current version."""
        return self._read(self.places())

    def lookup(self, keys: Sequence[object]) -> DataFrame:
        """The rows of a few keys; only their buckets are opened."""
        _, count = self._required()
        wanted = local_frame(self.spark, [{self.key: k} for k in keys], T.StructType([self.schema[self.key]]))
        touched = self._touched(wanted, count)
        return self._read({b: f for b, f in self.places().items() if b in touched}).where(F.col(self.key).isin(list(keys)))

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.schema[self.key].dataType)), F.lit(count)).cast("int")

    def _touched(self, rows: DataFrame, count: int) -> set[int]:
        return {r[0] for r in rows.select(self._bucket(count)).distinct().collect()}

    def _write(self, rows: DataFrame, count: int, touched: int) -> str:
        """Rows by bucket in a new folder: a task writes whole buckets, so a bucket is one file."""
        folder = uuid.uuid4().hex
        rows.withColumn("bucket", self._bucket(count)).repartition(max(1, touched), "bucket").write.partitionBy(
            "bucket").parquet(f"{self.root}/data/{folder}")
        return folder

    def _switch(self, places: Mapping[int, str], count: int) -> None:
        version = f"v-{uuid.uuid4().hex}"
        local_frame(self.spark, [{"bucket": b, "folder": f} for b, f in sorted(places.items())], _PLACES).coalesce(1).write.json(
            f"{self.root}/_places/{version}")
        row = {"version": version, "buckets": count, "finished_at": datetime.now(UTC)}
        local_frame(self.spark, [row], _SWITCH).write.mode("append").json(f"{self.root}/_versions")

    def replace(self, rows: DataFrame, buckets: int) -> None:
        """The table anew from ``rows``, in ``buckets`` buckets; the first version and a run that clears are made so.

        The rows hold a key once (``upsert`` into an empty table folds several).
        """
        if buckets < 1:
            raise ValueError("a table has one bucket at least")
        folder = self._write(rows.select(*self.schema.names), buckets, buckets)
        written = self.spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])).parquet(
            f"{self.root}/data/{folder}")
        self._switch({r[0]: folder for r in written.select("bucket").distinct().collect()}, buckets)

    def upsert(self, updates: DataFrame, order: Sequence[str], defaults: Mapping[str, object] | None = None) -> int:
        """New over old over default, column by column, as ``merge.upsert``; returns the number of buckets rewritten.

        Rows without a key are stored nowhere.  Updates are folded per key once and written; the
        buckets they fall into are then joined with them.
        """
        _, count = self._required()
        shared = shared_columns(self.schema.names, updates.columns, self.key, order)
        folded = materialize(reduce_updates(updates, self.key, order, shared), "bucket-updates")
        touched = self._touched(folded, count)
        if not touched:
            return 0
        places = self.places()
        old = self._read({b: f for b, f in places.items() if b in touched})
        folder = self._write(merge_folded(old, folded, self.key, shared, defaults), count, len(touched))
        self._switch({**places, **dict.fromkeys(touched, folder)}, count)
        return len(touched)
