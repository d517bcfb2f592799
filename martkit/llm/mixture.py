"""Mixing sources to target weights by entropy balancing.

Each document gets a rate ``min(most, exp(l * size / mean))``: the rates nearest to 1 in
relative entropy, among those at most ``most``, whose expected words of each source meet
its target.  The dual has one multiplier per source and is convex; Newton steps, kept
inside a shrinking bracket, solve it for all sources at once.  Every step is one
aggregation over a small table of (source, size, number of documents), made once by a
partial aggregate over the corpus; multipliers stay a table joined by source.

Rates become copies by ordered sampling: the whole part is taken, and the extra copy goes
to the documents for which a hash of the document (its id and text) minus the fraction is smallest, up to
the point where the source's words come nearest to its target.  That point is found by
counting into ever finer bins, so no source is sorted or gathered in one task.  Where many rows have
that very place (rows that repeat), as many of them are taken as the target needs: they are numbered by the parts they
were written in, each part by itself.

Null sources are one source, the last; null and empty texts have size 0 and are taken 0
words; repeated rows are taken as often as each other but for one copy; reruns agree on values, as everything depends on
them alone.  Weights follow the order of the sources by code point.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.base import stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: Newton steps; what has not converged by then is bisected.
ROUNDS = 60


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII space and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source (``source``, ``source_size``): its ``target`` words.

    The total is shared by weight; a source that would get more than ``most`` times its
    size gets that, and what is left is shared again among the others until none is above.
    Water filling: with ratio r = weight / size descending, the sources at their bound are
    a prefix of that order, so one window of running sums finds all rounds at once.
    """
    # One row per source: the windows below hold the list of sources, not documents.
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.select("source", "source_size", (F.row_number().over(by_name) - 1).alias("k")).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int")))
    by_ratio = Window.orderBy(F.col("ratio").desc(), F.col("k"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = ranked.withColumn(
        "ratio", F.when(F.col("source_size") > 0, F.col("weight") / F.col("source_size")).otherwise(F.lit(float("inf")))
    ).select(
        "*", F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("bound_size"),
        F.sum("weight").over(after).alias("free_weight"), F.sum("source_size").over(everything).alias("total"),
    ).withColumn("share", F.col("weight") * (F.col("total") - most * F.col("bound_size")) / F.col("free_weight"))
    bound = F.col("share") >= most * F.col("source_size")
    # The first source of the order that stays below its bound fixes the level for the rest.
    level = F.min(F.when(~bound, F.struct((-F.col("ratio")).alias("r"), "k", (F.col("share") / F.col("weight")).alias("v")))
                  ).over(everything)
    return filled.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("level").isNull() | (F.struct((-F.col("ratio")).alias("r"), "k") <
                                          F.struct(F.col("level.r").alias("r"), F.col("level.k").alias("k"))),
               most * F.col("source_size")).otherwise(F.col("weight") * F.col("level.v")).cast("double").alias("target"))


def rate(size: Column, mean: Column, multiplier: Column, most: float = MOST) -> Column:
    return F.least(F.lit(most), F.exp(F.least(multiplier * size / mean, F.lit(60.0))))


def balance(counts: DataFrame, goals: DataFrame, most: float = MOST, rounds: int = ROUNDS,
            tolerance: float = 1e-7) -> DataFrame:
    """One multiplier ``x`` per source, such that the rates' expected words meet the target.

    ``counts``: source, size (1 at least), n; ``goals``: source, target.  Each round is one
    aggregation with one row per source; a source that has converged keeps its value.
    """
    means = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    # With sizes of 1 at least, the ends of the bracket give the rates ``most`` and practically zero.
    state = stored(goals.join(means, goals["source"].eqNullSafe(means["source"])).select(
        goals["source"], "target", "mean", F.lit(0.0).alias("x"), (F.col("mean") * -60.0).alias("low"),
        (F.col("mean") * 60.0).alias("high"), F.lit(False).alias("done")), "mix-state")
    for k in itertools.count():  # ends: bisection alone halves every bracket
        rows = counts.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        taken = rate(F.col("size"), F.col("mean"), F.col("x"), most)
        mass = F.col("n") * F.col("size") * taken
        slope = F.when(taken < most, mass * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))
        step = rows.groupBy(F.col("s.source").alias("source")).agg(
            *[F.first(c).alias(c) for c in ("target", "mean", "x", "low", "high", "done")],
            F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        off = F.col("mass") - F.col("target")
        low = F.when(off < 0, F.col("x")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("x")).otherwise(F.col("high"))
        newton = F.try_divide(-off, F.col("slope")) + F.col("x")
        inside = F.lit(k < rounds) & (F.col("slope") > 0) & (newton > low) & (newton < high)
        done = F.col("done") | (F.abs(off) <= tolerance * F.greatest(F.col("target"), F.lit(1.0))) | (
            high - low < F.col("mean") * 1e-12)
        state = stored(step.select(
            "source", "target", "mean", F.when(done, F.col("x")).when(inside, newton).otherwise((low + high) / 2)
            .alias("x"), low.alias("low"), high.alias("high"), done.alias("done")), "mix-state")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("source", "target", "mean", "x")


LEVELS, BITS = 3, 12


def _hash(seed: int) -> Column:
    """Of a document: its id and text; a null is not an empty text."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").isNull(), F.col("text"))


def _place(hashed: Column, fraction: Column) -> Column:
    """A hash of the document in [0, 1) less its fraction, as a whole number of LEVELS * BITS bits."""
    top = 1 << (LEVELS * BITS - 1)
    uniform = F.pmod(hashed, F.lit(top))
    return F.greatest(F.lit(0).cast("bigint"), uniform - F.floor(fraction * top) + F.lit(top))


def _columns(most: float) -> dict[str, Column]:
    """For a row with hash, size, mean and x: whole copies, whether one more may be taken, its place in line."""
    r = F.coalesce(rate(F.col("size"), F.col("mean"), F.col("x"), most), F.lit(0.0))
    whole = F.floor(r).cast("bigint")
    return {"whole": whole, "open": (F.col("size") > 0) & (whole + 1 <= most), "place": _place(F.col("hash"), r - whole)}


def cut_places(rated: DataFrame, multipliers: DataFrame) -> DataFrame:
    """Per source: the place in line up to which the extra copies are taken (``cut``, itself not included), and, where
    some but not all rows of that place are, how many (``part``, else null).

    ``rated``: source, size, whole, open, place.  Each level counts the words of 4,096 bins
    of the one bin, per source, that the level before left open.
    """
    base = rated.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("base"))
    state = stored(multipliers.join(base, multipliers["source"].eqNullSafe(base["source"])).select(
        multipliers["source"], "mean", "x", (F.col("target") - F.col("base")).alias("missing"),
        F.lit(0).cast("bigint").alias("cut"), F.lit(0).cast("bigint").alias("mass"), F.lit(0).cast("bigint").alias("rows")), "mix-cut")
    for level in range(1, LEVELS + 1):
        shift = (LEVELS - level) * BITS
        rows = rated.filter("open").alias("r").join(state.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        bins = rows.filter(F.shiftright("r.place", shift + BITS) == F.col("s.cut")).groupBy(
            F.col("s.source").alias("source"), F.shiftright("r.place", shift).alias("bin")).agg(
            F.first("s.missing").alias("missing"), F.sum("r.size").alias("mass"), F.count("*").alias("rows"))
        line = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        crossed = bins.withColumn("sum", F.sum("mass").over(line)).filter(F.col("sum") > F.col("missing")).groupBy(
            "source").agg(F.min(F.struct("bin", "mass", "rows", (F.col("missing") - F.col("sum") + F.col("mass")).alias("rest"))).alias("at"))
        # Without a crossing every open document is taken: the cut lies beyond the last bin.
        beyond = F.when(F.lit(level == 1), F.lit(1 << BITS).cast("bigint")).otherwise(F.shiftleft("s.cut", BITS))
        state = stored(state.alias("s").join(crossed.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
            "s.source", "s.mean", "s.x", F.coalesce("c.at.rest", "s.missing").alias("missing"),
            F.coalesce("c.at.bin", beyond).alias("cut"), F.coalesce("c.at.mass", F.lit(0)).alias("mass"),
            F.coalesce("c.at.rows", F.lit(0)).alias("rows")), "mix-cut")
    # So many documents at the cut itself come in as bring the source nearest to its target.
    near = F.when(F.col("mass") > 0, F.floor(F.col("missing") * F.col("rows") / F.col("mass") + 0.5)).otherwise(F.col("rows"))
    near = F.greatest(F.lit(0), F.least(F.col("rows"), near)).cast("bigint")
    return state.withColumn("near", near).select(
        "source", "mean", "x", F.when(F.col("near") == F.col("rows"), F.col("cut") + 1).otherwise(F.col("cut")).alias("cut"),
        F.when((F.col("near") > 0) & (F.col("near") < F.col("rows")), F.col("near")).alias("part"))


def plan_mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 11):
    """(sized, plan): doc_id, source, size per row; per source its size, target and what decides on copies."""
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                               word_count(F.col("text")).alias("size"), _hash(seed).alias("hash")), "mix-sized")
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    goals = stored(targets(sizes, weights, most), "mix-targets")
    counts = stored(sized.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    multipliers = balance(counts, goals, most)
    rated = stored(_joined(sized, multipliers).select(
        "source", "size", *[c.alias(n) for n, c in _columns(most).items()]), "mix-rated")
    cuts = cut_places(rated, multipliers)
    plan = goals.alias("g").join(cuts.alias("k"), F.col("g.source").eqNullSafe(F.col("k.source")), "left").select(
        "g.source", "g.source_size", "g.target", "k.mean", "k.x", "k.cut", "k.part")
    return sized, stored(plan, "mix-plan")


def _joined(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """The columns of a source beside each of its rows; sources are few or split by adaptive execution."""
    s = per_source.withColumnRenamed("source", "its_source")
    return rows.join(s, rows["source"].eqNullSafe(s["its_source"]), "left").drop("its_source")


def with_copies(rows: DataFrame, plan: DataFrame, most: float = MOST) -> DataFrame:
    """Rows with source, size and hash, their source's columns and ``copies``: how often each is taken."""
    c = _columns(most)
    joined = _joined(rows, plan)
    sure = F.when(F.col("size") > 0, F.coalesce(c["whole"] + (c["open"] & (c["place"] < F.col("cut"))).cast("bigint"), F.lit(0))).otherwise(
        F.lit(0)).cast("bigint")
    told = joined.withColumn("copies", sure)
    if plan.filter("part is not null").isEmpty():
        return told
    # Rows at a cut that takes some of them: written with the part they come from, and numbered through the parts.
    at = F.coalesce(c["open"] & (c["place"] == F.col("cut")) & F.col("part").isNotNull(), F.lit(False))
    cut = stored(told.filter(at).withColumn("_part", F.spark_partition_id()), "mix-at-cut")
    line = Window.partitionBy("_source").orderBy("_its_part").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy(F.col("source").alias("_source"), F.col("_part").alias("_its_part")).agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(line), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("source", "_part").orderBy("hash"))
    numbered = cut.withColumn("_number", within).join(
        before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_its_part")))
    taken = numbered.withColumn("copies", F.col("copies") + (F.col("_number") + F.col("_before") <= F.col("part")).cast("bigint"))
    return told.filter(~at).unionByName(taken.select(*told.columns))


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 11) -> DataFrame:
    """Per document: its size, its source's size and target, its copies and the words taken."""
    sized, plan = plan_mixture(docs, weights, most, seed)
    rows = with_copies(sized, plan, most)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 11) -> DataFrame:
    """The mixed corpus: every row as often as it is taken, columns as they came."""
    _, plan = plan_mixture(docs, weights, most, seed)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text")).alias("size"), _hash(seed).alias("hash"))
    taken = with_copies(rows, plan, most).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("i")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])
