import random

import numpy as np
import pytest

from conftest_llm import prose
from martkit.llm import hyperminhash
from martkit.llm.hyperminhash import BUCKETS, ROUNDS, _common, chance_equal, least_counts, likely, near_copies, registers, shingle_sets
from martkit.llm.jaccard import _mix


def plain_registers(hashes):
    out = []
    for r in range(ROUNDS):
        seeds = [int(v) for v in _mix(np.array([2 * r, 2 * r + 1], np.uint64), 77)]
        least, row = {}, [0xFFFF] * BUCKETS
        for h in hashes.tolist():
            x = (h ^ seeds[0]) * (seeds[1] | 1) % 2**64
            least[x >> 62] = min(least.get(x >> 62, 2**62), x % 2**62)
        for bucket, v in least.items():
            zeros = 62 - v.bit_length()
            row[bucket] = zeros << 10 | (v << zeros + 1) % 2**62 >> 52
        out.append(row)
    return out


def plain_components(rows, percent=85):
    """(doc_id, n, component, kept) by comparing all pairs of word triples."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, *_ in rows:
        w = (text or "").translate(table).encode().split()
        sets.append({tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(root(i)), r[0] == least.get(root(i))) for i, r in enumerate(rows)), key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_registers_equal_plain_ones():
    rng = np.random.default_rng(2)
    odd = np.array([0, 1, 2**53 - 1, 2**53 + 1, 2**62 - 1, 2**62, 2**63, 2**64 - 1], np.uint64)
    sets = [odd, np.zeros(0, np.uint64), *(np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 5, 300))]
    got = registers(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert got.tolist() == [plain_registers(s) for s in sets]


def test_no_link_is_turned_away_by_the_estimate():
    rng = np.random.default_rng(3)
    n, least = 300, least_counts(85, ROUNDS * BUCKETS)
    one, two, bounds = [], [], [0]
    for _ in range(300):
        base = rng.integers(0, 2**64, n + 24, dtype=np.uint64)
        one.append(base[:n])
        two.append(np.concatenate([base[24:]]))
        bounds.append(bounds[-1] + n)
    x, y = (registers(np.concatenate(s), np.array(bounds)).reshape(300, -1).view(np.int64) for s in (one, two))
    sizes = np.full(300, float(n))
    assert likely(x, y, sizes, sizes, 85, least).all()
    strangers = likely(x[:-1], y[1:], sizes[1:], sizes[1:], 85, least)
    assert not strangers.any() and 0 < chance_equal(sizes[:1], sizes[:1])[0] < 1e-3


def test_bit_sets_count_intersections():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(20)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(20), np.arange(20)))
    assert _common(sets, sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


@pytest.mark.parametrize("small,block", [(24, 512), (3, 8)])
def test_equals_all_pairs(frame, monkeypatch, small, block):
    monkeypatch.setattr(hyperminhash, "SMALL", small)
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rng = random.Random(small)
    base = prose(1, 150).split()
    # One large group of copies with edits of many kinds: some linked, some near the threshold, some not.
    rows = [(i, edited(rng, base, rng.randrange(0, 12))) for i in range(120)]
    rows += [(1000 + i, prose(i % 30, 20 + i % 30)) for i in range(80)] + [(2000 + i, "same text in many rows of the table") for i in range(40)]
    rows += [(3000, "a b"), (3001, "A\tB"), (3002, "a"), (3003, "a b c"), (3004, "a b c d e f g"), (3005, "a b c d e f g h")]
    rng.shuffle(rows)
    df = frame(rows)
    assert rows_of(near_copies(df)) == plain_components(rows)


def test_nulls_repeated_rows_and_empty_table(frame, edge_rows):
    rows = edge_rows + [(None, prose(3)), (None, None), (None, "unique words of nobody here"), (None, "unique words of nobody here")] + [
        (77, "one row that stands very often in the table")] * 50
    assert rows_of(near_copies(frame(rows).repartition(4))) == [
        (*r[:3], r[0] == r[2]) for r in plain_components(rows)]
    assert near_copies(frame([])).count() == 0


def test_shingles_are_three_words_with_plain_letters_folded():
    hashes, bounds = shingle_sets(["Ab c\x0bD e", "ab C d E", "Éa b", "éa b", "x", ""])
    sets = [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and sets[2] != sets[3] and len(sets[4]) == 1 and not sets[5]
