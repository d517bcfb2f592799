"""Exact nearest vectors by inner product, with a pivot table.

Vectors are rounded to whole numbers, so scores are exact.  For every vector the distances to
a fixed number of pivots are stored.  By the triangle inequality |d(q, p) - d(x, p)| is a lower
bound of d(q, x) for every pivot p; the largest of them gives an upper bound of the inner product,
as 2 q.x = |q|^2 + |x|^2 - d(q, x)^2.  A query looks at the candidates in the order of that bound
and stops when the best unseen bound is below its k-th score: nothing can be missed.

Queries are the rows whose id is divisible by ``every``; they are handled in blocks of bounded
size, each sent to all tasks once and run over all candidates.  A task returns k rows for each
query, which are merged by a ranking per query.

Vectors that are null or hold a null, a NaN or an infinity take no part, nor do rows without an
id.  Vectors of different lengths have no inner product: every length is searched by itself.
Rows with equal ids and equal vectors count once; with equal ids and different vectors each is a candidate
and each is a query's own.  A component whose whole number is no bigint, and a score that is none,
is an error, never a wrapped number.  An empty table has no result rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martkit.llm.base import Shared, stored

SCALE = 256
PIVOTS = 32
#: Queries sent to a task at once: at most this many vectors, a proven bound of the broadcast.
QUERY_BLOCK = 4096
#: Candidates whose bounds are held against all queries of a block at once.
ROWS = 2048


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``: the vector's components times ``scale``, rounded down; only usable vectors."""
    usable = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).filter(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0)
        & F.forall("e", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))))
    def rounded(x):
        fits = F.abs(x * scale) < F.lit(2.0**63)
        return F.when(fits, F.floor(x * scale).cast("bigint")).otherwise(
            F.raise_error(F.concat(F.lit("no bigint: a component of vector "), F.col("vec_id").cast("string"))).cast("bigint"))
    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("e", rounded).alias("v")).distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.zeros((0, 0))


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances are whole numbers and exact, however large; the root is rounded."""
    if _exact(np.concatenate([rows, pivots]), pivots) is object:
        rows, pivots = rows.astype(object), pivots.astype(object)
    square = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (rows @ pivots.T)
    return np.sqrt(np.maximum(square, 0).astype(np.float64))


def _pivot_table(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column("v")), pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(list(d), pa.list_(pa.float64()))],
                    names=["vec_id", "v", "d"])
    return run


def choose_pivots(whole: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Far-apart vectors of a bounded sample: each next one is farthest from those chosen.

    Pivots only steer the order of the search, never its result.
    """
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(32 * pivots).collect()
    rows = np.array([r["v"] for r in sample], np.int64)
    if not len(rows):
        return rows
    chosen = [0]
    nearest = _distances(rows, rows[:1])[:, 0]
    while len(chosen) < min(pivots, len(rows)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def _exact(rows: np.ndarray, queries: np.ndarray) -> type:
    """The fastest type in which every product of the two sides, and every sum of them, is exact."""
    most = _top(rows) * _top(queries) * max(rows.shape[1], 1)
    return np.float64 if most < 2**52 else np.int64 if most < 2**62 else object


def _top(rows: np.ndarray) -> int:
    return max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))


def _search(shared: Shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, query_d = shared.value
        square = (queries.astype(np.float64) ** 2).sum(1)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = part.column("vec_id").to_numpy()
                rows, d = _matrix(part.column("v")), _matrix(part.column("d"))
                near = np.zeros((len(query_ids), len(ids)))
                for p in range(d.shape[1]):
                    np.maximum(near, np.abs(query_d[:, p, None] - d[None, :, p]), out=near)
                # A little more than the bound, for the rounding of the roots and of the squares.
                sides = square[:, None] + (rows.astype(np.float64) ** 2).sum(1)[None, :]
                bound = (sides * (1 + 1e-12) - near**2 * (1 - 1e-9)) / 2 + 1e-3
                kind = _exact(rows, queries)
                exact, asked = rows.astype(kind, copy=False), queries.astype(kind, copy=False)
                for q in range(len(query_ids)):
                    best[q] = _scan(int(query_ids[q]), asked[q], bound[q], ids, exact, best[q], k)
        out = [(int(q), int(i), int(s)) for q, (ids, scores) in zip(query_ids, best) for i, s in zip(ids, scores)]
        if out:
            q, i, s = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, i, s)],
                                             names=["query_id", "vec_id", "score"])
    return run


def _scan(own: int, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, rows: np.ndarray, best, k: int):
    """The k best of ``best`` and the candidates, evaluated in bound order in growing steps."""
    top_ids, top_scores = best
    worth = np.arange(len(ids)) if len(top_scores) < k else np.flatnonzero(bound >= top_scores[-1])
    order = worth[np.argsort(-bound[worth], kind="stable")]
    at, step = 0, 32
    while at < len(order) and (len(top_scores) < k or bound[order[at]] >= top_scores[-1]):
        some = order[at:at + step]
        some = some[ids[some] != own]
        scores = rows[some] @ query
        if scores.dtype == object and any(abs(int(x)) >= 2**63 for x in scores):
            raise OverflowError(f"a score of vector {own} is no bigint")
        scores = scores.astype(np.int64)
        all_ids, all_scores = np.concatenate([top_ids, ids[some]]), np.concatenate([top_scores, scores])
        keep = np.lexsort((all_ids, -all_scores))[:k]
        top_ids, top_scores = all_ids[keep], all_scores[keep]
        at, step = at + step, step * 2
    return top_ids, top_scores


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple]:
    held = []
    for row in queries.toLocalIterator():
        held.append((row["vec_id"], row["v"], row["d"]))
        if len(held) == size:
            yield tuple(np.array(x) for x in zip(*held))
            held = []
    if held:
        yield tuple(np.array(x) for x in zip(*held))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query, ties to the smaller id."""
    spark = vectors.sparkSession
    usable = stored(whole_vectors(vectors), "pivot-vectors")
    # Lengths that occur among the queries; vectors of any other length meet none.
    lengths = [r[0] for r in usable.filter(F.col("vec_id") % every == 0).select(F.size("v")).distinct().collect()]
    found = []
    for length in sorted(lengths):
        whole = usable.filter(F.size("v") == length)
        table = stored(whole.mapInArrow(_pivot_table(Shared(spark, choose_pivots(whole, pivots))),
                                        "vec_id bigint, v array<bigint>, d array<double>"), "pivot-table")
        for block in _blocks(table.filter(F.col("vec_id") % every == 0), QUERY_BLOCK):
            found.append(stored(table.mapInArrow(_search(Shared(spark, block), k),
                                                 "query_id bigint, vec_id bigint, score bigint"), "pivot-found"))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
