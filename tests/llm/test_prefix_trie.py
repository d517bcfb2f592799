import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from martkit.llm import prefix_trie
from martkit.llm.prefix_trie import RangeMinimum, branched_trie, prefix_trie as trie, turn_lists

EXTRA = ["names", "sizes", "path", "shard", "low", "n", "class", "depth", "side", "key"]
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])


@pytest.fixture(scope="module")
def turns(spark):
    return lambda rows: spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def plain_trie(lists):
    """From {conv_id: [(role, text), ...]}: rows as the operator gives them."""
    members, ends = {}, {}
    for c, own in lists.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
        ends.setdefault(tuple(own), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    rows = []
    for p, m in members.items():
        below = [(q, k) for q, k in members.items() if q[:len(p)] == p]
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), sum(q not in kids for q, _ in below),
                     sum((len(k) - 1) * len(q[-1][1].encode()) for q, k in below if q),
                     hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(rows, key=repr)


def plain_lists(rows, branch=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    if not branch:
        return own
    out = {}
    for c, x in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, int(c - np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + x[h:]
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(rng, n):
    rows = []
    for c in rng.sample(range(-20, 6 * n), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, rng.choice([t, t * 2]) if t else rng.choice([None, 0]), rng.choice(["user", "user", "bot", None]),
                         rng.choice(["a", "b", "", "é", None, "long text"]) if t > 1 else "hello"))
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())  # no ties but those of a test of its own
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [1, 2, 7, 1 << 17])
def test_equals_a_plain_trie_in_shards_of_any_size(turns, shard):
    rows = made(random.Random(shard), 80)
    assert rows_of(branched_trie(turns(rows), rows=shard)) == plain_trie(plain_lists(rows))


def test_many_copies_and_one_first_turn(turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 16)
    rows = [(c, 0, "user", "hi") for c in range(700)] + [(c, 1, "bot", "same" if c % 3 else str(c)) for c in range(700)]
    df = turns(rows).repartition(5)
    lists = turn_lists(df)
    assert rows_of(trie(lists, rows=50)) == plain_trie(plain_lists(rows, branch=False))


def test_nulls_ties_repeated_rows_and_long_conversations(turns):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 0, None, ""), (2, 0, "user", "x"),
            (2, 0, "user", "x"), (3, 5, "user", "only")] + [(9, t, "user", str(t % 7)) for t in range(700)]
    want = plain_trie(plain_lists([r for r in rows if r[0] != 2], branch=False))
    assert rows_of(trie(turn_lists(turns([r for r in rows if r[0] != 2])), rows=2)) == want
    # Turns of one number are put in order by their names, the same way each time.
    one, two = (rows_of(branched_trie(turns(x))) for x in (rows, rows[::-1]))
    assert one == two and one[0][1] >= 0


def test_rebuilt_conversation_without_turns_is_a_member_of_the_root(turns):
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "gone")]
    assert rows_of(branched_trie(turns(rows))) == plain_trie({c: []})


def test_empty_table(turns):
    assert branched_trie(turns([])).count() == 0
    assert "saved_tokens" in branched_trie(turns([])).columns


def test_range_minimum_searches_equal_plain_ones():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 6, 70)
    values[0] = -1
    table = RangeMinimum(values)
    at, least = rng.integers(0, 70, 300), rng.integers(0, 7, 300)
    for a, d, first, last in zip(at, least, table.first_with(at, least), table.last_with(at, least)):
        assert all(values[first + 1:a + 1] >= d) and (first == 0 or values[first] < d)
        assert all(values[a + 1:last + 1] >= d) and (last == 69 or values[last + 1] < d)
    low = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
    assert table.of(*low).tolist() == [values[a:b + 1].min() for a, b in zip(*low)]


def test_first_turn_shared_by_all_is_one_row_a_shard(spark, turns):
    rows = [(c, t, "user", "hi" if t == 0 else f"{c}-{t}") for c in range(300) for t in range(3)]
    out = trie(turn_lists(turns(rows)), rows=10)
    top = out.filter("depth <= 1").collect()
    assert sorted((r.depth, r.n_convs, r.n_children, r.n_leaves) for r in top) == [(0, 300, 1, 300), (1, 300, 300, 300)]
    assert out.agg(F.sum("n_leaves")).first()[0] == 300 * 4
