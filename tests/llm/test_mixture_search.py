"""The mix meets its targets, and the search equals a full scan."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm.mixture import MOST, mix, mixture, targets
from martkit.llm.pivot_search import nearest


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, bound = sum(sizes.values()), {}
    while True:
        left, free = total - sum(bound.values()), [n for n in names if n not in bound]
        share = {n: weight[n] * left / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > most * sizes[n]]
        if not over:
            return {**share, **bound}
        bound |= {n: most * sizes[n] for n in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, "d": 5, None: 3}, {"é": 7, "z": 0, "A": 9, None: 0}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want) and all(math.isclose(got[n], want[n], abs_tol=1e-9) for n in want)


def test_mix(spark, frame, edge_rows):
    rows = [(1000 + i, prose(i, 5 + i * 37 % 90), ["x", "y", "z", None][(i % 10 > 2) * (i % 4)]) for i in range(400)]
    docs = frame([*rows, *edge_rows])
    got = mixture(docs).collect()
    assert len(got) == len(rows) + len(edge_rows)
    source = {r[0]: (r[2] if len(r) > 2 else "a") for r in [*rows, *edge_rows]}
    taken, target, largest = {}, {}, {}
    for r in got:
        assert r.taken == r.copies * r.size and r.taken <= MOST * r.size
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        largest[s] = max(largest.get(s, 0), r.size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert sorted(map(tuple, mixture(docs).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    mixed = mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixture(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0


def plain_search(rows, k=5, every=50):
    out = []
    for q, v in rows:
        if q % every:
            continue
        scores = sorted((-int(np.dot(v, w)), c) for c, w in rows if c != q)[:k]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)]
    return sorted(out)


def test_search(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), "d") for i in range(400)]
    rows += [(1000 + i, rows[50][1], "d") for i in range(20)]
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in rows]
    odd = [(7000, None, "d"), (7050, [1.0, None] + [0.0] * 6, "d"), (7100, [float("nan")] * 8, "d"), (7150, [float("inf")] * 8, "d"),
           (None, [1.0] * 8, "d"), (7200, [1.0] * 3, "d"), rows[0]]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, d string").repartition(3)
    assert sorted(map(tuple, nearest(df).collect())) == plain_search(whole)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, d string")
    assert sorted(map(tuple, nearest(few).collect())) == plain_search(whole[:3])
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.filter(F.col("vec_id") == 51)).count() == 0
