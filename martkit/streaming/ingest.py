"""A stream of items, validated and merged by key.

Each micro-batch is validated; rows the table would refuse go to a folder of rejects, the
others to a change log, both in a folder of the batch's own (``batch_id=N``, overwritten
when the batch is replayed, so a replay changes nothing).  The current table is the base
plus the log, folded by key; a batch therefore costs as much as its own rows, however large
the table has grown.  ``fold_levels`` keeps the log short as batches come: runs of batches are
folded into the rows of theirs that still matter, runs of folded runs again, so that after n
batches a read opens some log n folders and every row was rewritten log n times.  ``compact``
rewrites the whole older part at once.

Batch numbers belong to a checkpoint, so a log takes batches under one checkpoint only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from martkit.operators.clean import quarantine, storage_problems
from martkit.operators.merge import upsert, upsert_stats
from martkit.operators.stats import validation_stats
from martkit.schemas import TableRules
from martkit.session import folder_names, local_frame
from martkit.sources.readers import is_absent

_OWNER = T.StructType([T.StructField("checkpoint", T.StringType())])
_FOLDED = T.StructType([T.StructField("folder", T.StringType()), T.StructField("first", T.LongType()),
                        T.StructField("upto", T.LongType()), T.StructField("level", T.IntegerType())])
#: Batches, or runs of one level, that are folded into a run of the next one.
FAN = 8
# The counters of a run.
COUNTERS = ["total_processed", "cleaned_prices", "cleaned_ints", "fixed_dates", "validation_errors"]


@dataclass(frozen=True)
class Run:
    """Batches ``first`` to ``upto``, folded into the rows in ``folder``."""

    first: int
    upto: int
    level: int
    folder: str


@dataclass(frozen=True)
class ChangeLog:
    """Where a stream keeps its changes, and how they fold into a table.

    ``order`` names the columns that put the changes of a key in sequence; the
    batch number comes before them unless ``by_arrival`` is off.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    order: Sequence[str]
    by_arrival: bool = True

    def _read(self, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
        """A table below the log; no rows where there is none yet.  Any other trouble is raised."""
        try:
            return self.spark.read.schema(schema).format(fmt).load(path)
        except AnalysisException as e:
            if not is_absent(e):
                raise
            return local_frame(self.spark, [], schema)

    def bind(self, checkpoint: str) -> None:
        """Claim the log for one checkpoint: another one would number its batches from 0 again."""
        path = f"{self.path}/_stream"
        owners = {r["checkpoint"] for r in self._read(path, _OWNER, "json").collect()}
        if owners - {checkpoint}:
            raise ValueError(f"the log {self.path} holds batches of the checkpoint {owners}; "
                             "continue with that one, or start another log")
        if not owners:
            local_frame(self.spark, [{"checkpoint": checkpoint}], _OWNER).write.mode("append").json(path)

    def write_batch(self, batch: DataFrame, batch_id: int, part: str = "changes") -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{part}/batch_id={batch_id}")

    @property
    def _numbered(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])

    def _runs(self) -> list[Run]:
        """The folded runs in use, oldest first: those that no later run holds the batches of."""
        rows = self._read(f"{self.path}/_compacted", _FOLDED, "json").collect()
        runs = sorted((Run(r["first"] or 0, r["upto"], r["level"] or 1, r["folder"]) for r in rows), key=lambda r: (r.first, -r.upto, r.folder))
        used: list[Run] = []
        for run in runs:
            if not used or run.upto > used[-1].upto:
                used.append(run)
        return used

    def _batches(self) -> list[int]:
        """The numbers of the batches stored, from the names of their folders."""
        names = folder_names(self.spark, f"{self.path}/changes")
        return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))

    def _rows_of(self, runs: Sequence[Run], batches: Sequence[int]) -> DataFrame:
        parts = []
        if runs:
            parts.append(self.spark.read.schema(self._numbered).parquet(*[f"{self.path}/{r.folder}" for r in runs]))
        if batches:
            parts.append(self.spark.read.schema(self._numbered).option("basePath", f"{self.path}/changes").parquet(
                *[f"{self.path}/changes/batch_id={b}" for b in batches]))
        return reduce(DataFrame.unionByName, parts) if parts else local_frame(self.spark, [], self._numbered)

    def changes(self) -> DataFrame:
        """The rows in the log: folded runs, and the batches after them as they came."""
        runs = self._runs()
        upto = runs[-1].upto if runs else -1
        return self._rows_of(runs, [b for b in self._batches() if b > upto])

    def rejects(self, rules: TableRules) -> DataFrame:
        """Refused rows of all batches with their reasons, as text."""
        fields = [T.StructField(f.name, T.StringType()) for f in rules.schema]
        reason = [T.StructField("reject_reason", T.StringType()), T.StructField("batch_id", T.LongType())]
        return self._read(f"{self.path}/rejects", T.StructType([*fields, *reason]))

    def counters(self) -> DataFrame:
        """The validation counters of all batches, added up."""
        fields = [T.StructField(c, T.LongType()) for c in COUNTERS]
        rows = self._read(f"{self.path}/counters", T.StructType([*fields, T.StructField("batch_id", T.LongType())]))
        total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
        good = F.col("total_processed") - F.col("validation_errors")
        return total.withColumn("success_rate", F.coalesce(
            F.try_divide(good, F.col("total_processed")) * 100, F.lit(0.0)))

    @property
    def full_order(self) -> list[str]:
        return [*(["batch_id"] if self.by_arrival else []), *self.order]

    def _ordered(self) -> DataFrame:
        rows = self.changes()
        return rows if self.by_arrival else rows.drop("batch_id")

    def current(self, base: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
        """The base table with all changes merged in."""
        return upsert(base, self._ordered(), self.key, self.full_order, defaults)

    def stats(self, base: DataFrame) -> DataFrame:
        """Counts of the rows in the log; a compacted log has fewer of them than were sent."""
        return upsert_stats(base, self._ordered(), self.key, self.full_order)

    def _fold(self, rows: DataFrame, first: int, upto: int, level: int) -> Run:
        """A new run: of these rows the ones that give a key the value of some column.

        They keep their order values, so a change that arrives late and is older still loses.
        The run counts from the moment its one marker row is written.
        """
        place = F.struct(*self.full_order)
        fields = [c for c in self.schema.names if c != self.key and c not in self.order]
        # The last place at which each column was sent, and the last row of the key as such.
        winners = rows.groupBy(self.key).agg(F.max(place).alias("_last"), *[
            F.max(F.when(F.col(c).isNotNull(), place)).alias(f"_at_{c}") for c in fields])
        places = winners.select(F.col(self.key).alias("_key"), F.explode(F.array_distinct(F.array_compact(
            F.array("_last", *[f"_at_{c}" for c in fields])))).alias("_place"))
        held = rows.join(places, F.col(self.key).eqNullSafe(F.col("_key")) & place.eqNullSafe(F.col("_place")), "left_semi")
        run = Run(first, upto, level, f"_old/{uuid.uuid4().hex}")
        held.write.parquet(f"{self.path}/{run.folder}")
        local_frame(self.spark, [asdict(run)], _FOLDED).write.mode("append").json(f"{self.path}/_compacted")
        return run

    def compact(self) -> int | None:
        """Fold all batches but the last, which may be sent again, into one run.

        Batches are not deleted and may be expired by age.  Returns the last batch compacted.
        """
        runs, batches = self._runs(), self._batches()
        upto = runs[-1].upto if runs else -1
        later = [b for b in batches[:-1] if b > upto]
        if later or len(runs) > 1:
            top = max([r.level for r in runs], default=0) + 1
            upto = self._fold(self._rows_of(runs, later), 0, max(later, default=upto), top).upto
        return upto if upto >= 0 else None

    def fold_levels(self, fan: int = FAN) -> int:
        """Fold batches, all but the last, and runs of one level wherever ``fan`` of them stand in a row.

        One writer at a time: what ingests the log may do so after each batch.  Returns the number of runs written.
        """
        if fan < 2:
            raise ValueError("at least two runs are folded into one")
        runs, written = self._runs(), 0
        upto = runs[-1].upto if runs else -1
        later = [b for b in self._batches()[:-1] if b > upto]
        while len(later) >= fan:
            some, later = later[:fan], later[fan:]
            runs.append(self._fold(self._rows_of([], some), upto + 1, some[-1], 1))
            upto, written = some[-1], written + 1
            while len(runs) >= fan and len({r.level for r in runs[-fan:]}) == 1:
                some_runs = runs[-fan:]
                merged = self._fold(self._rows_of(some_runs, []), some_runs[0].first, some_runs[-1].upto, some_runs[0].level + 1)
                runs, written = [*runs[:-fan], merged], written + 1
        return written


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """Files that arrive in a folder, as a stream with a declared schema."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def stream_ingest(source: DataFrame, log: ChangeLog, validate: Callable[[DataFrame], DataFrame], checkpoint: str,
                  rules: TableRules | None = None, available_now: bool = True, fan: int | None = None) -> StreamingQuery:
    """Start the ingest; with ``available_now`` it ends when the waiting files are done.

    ``checkpoint`` is a folder on shared storage; starting again with it continues, and a log
    refuses any other one.  With ``rules`` the rows that the table would refuse go to the
    rejects, and the run goes on.  Where ``validate`` leaves its flags (``_validation``), the
    batch's counters are kept.  With ``fan`` the log's levels are folded after each batch.
    """
    log.bind(checkpoint)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Read up to three times; what is lost with an executor is computed again from the batch.
        checked = validate(batch).persist()
        try:
            if "_validation" in checked.columns:
                log.write_batch(validation_stats(checked).select(*COUNTERS), batch_id, "counters")
            good = checked
            if rules is not None:
                good, refused = quarantine(checked, storage_problems(checked, rules))
                names = [f.name for f in rules.schema if f.name in refused.columns]
                log.write_batch(refused.select(*[F.col(n).cast("string").alias(n) for n in names], "reject_reason"),
                                batch_id, "rejects")
            # The changes come last: with them the batch is stored.
            log.write_batch(good.select(*[
                F.col(f.name).try_cast(f.dataType).alias(f.name) for f in log.schema]), batch_id)
        finally:
            checked.unpersist()
        if fan is not None:
            log.fold_levels(fan)

    writer = source.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
