"""One row per key: keep the first, keep the latest, name the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from martkit.session import materialize

#: Copies of a row that one row is dealt out into at once.
PIECE = 10_000

def dedup_keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in ascending ``order`` (NULLs first).

    NULL keys form one group.  Spark turns the rank filter into a limit per
    group that runs before the shuffle, so a key that holds a third of all rows
    sends one row per input task, not a third of the table, to one place.
    Give an ``order`` without ties: an arbitrary winner would change when a task
    is run again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key in ``order``; same plan as ``dedup_keep_first``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_places(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key and order values of the first row per key, and ``_ties``: how many rows have that place.

    From one narrow pass: rows are counted per key and place by a partial aggregate, so neither a hot key nor a row that
    repeats itself meets in one task; then each task passes on one place a key.  Written once, for all that asks for it.
    """
    places = df.groupBy(*dict.fromkeys([*keys, *order])).agg(F.count("*").alias("_ties"))
    first = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return materialize(places.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"), "first-places")


def later_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], firsts: DataFrame | None = None) -> DataFrame:
    """Every row that is not the first of its key; with ``first_places`` it reads ``df`` once more, else twice in all.

    The first places are joined on key and order together, so the shuffle is even however many
    rows share one key.  Of rows that tie for the first place one stays, the smallest.  Where there are ties, the
    rows are written once with a mark; the tied ones are counted by a partial aggregate over all columns, the count of each
    key's smallest one is lowered by one, and the counts are dealt out again in pieces, so a table that repeats
    itself meets in no task either.
    """
    firsts = first_places(df, keys, order) if firsts is None else firsts
    on = [df[c].eqNullSafe(firsts[c]) for c in dict.fromkeys([*keys, *order])]
    if firsts.filter("_ties > 1").isEmpty():
        return df.join(firsts, on, "left_anti")
    row = F.struct(*[df[c].alias(c) for c in df.columns]).alias("_row")
    marked = df.join(firsts, on, "left").filter("_ties is null or _ties > 1").select(row, F.col("_ties").isNotNull().alias("_tied"))
    marked = materialize(marked, "later-rows")
    own = [F.col("_row")[k].alias(f"_k{i}") for i, k in enumerate(keys)]
    tied = marked.filter("_tied")
    counted = tied.groupBy("_row").agg(F.count("*").alias("_n")).withColumn("_own", F.xxhash64("_row"))
    # A row that is the smallest of its key loses one copy.
    least = tied.groupBy(*own).agg(F.min("_row").alias("_least")).select("_least", F.xxhash64("_least").alias("_h"))
    left = counted.join(least, (F.col("_own") == F.col("_h")) & F.col("_row").eqNullSafe(F.col("_least")),
                        "left").select("_row", (F.col("_n") - F.col("_least").isNotNull().cast("int")).alias("_n"))
    pieces = left.filter("_n > 0").select("_row", "_n", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / PIECE))).alias("_piece"))
    again = pieces.repartition("_row", "_piece").select("_row", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least(F.lit(PIECE).cast("bigint"), F.col("_n") - F.col("_piece") * PIECE))).alias("_copy"))
    return marked.filter("not _tied").select("_row.*").unionByName(again.select("_row.*"))


def dedup_stats(df: DataFrame, key: str) -> DataFrame:
    """records_before, records_after and duplicates_removed of a dedup by ``key``.

    NULL counts as one key.  Rows are grouped by key first: partial sums keep a
    hot key from reaching one task as single rows.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_before"),
        F.count("*").alias("records_after"),
    ).withColumn("duplicates_removed", F.col("records_before") - F.col("records_after"))
