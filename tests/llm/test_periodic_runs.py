import hashlib
import random
import zlib

import numpy as np

from martkit.llm.periodic_runs import Extensions, collapse_runs, find_runs, run_report


def plain_runs(w):
    """All stretches of equal words q apart, none extended, of each interval the smallest period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        a, g, old = h // 10 % len(w), h // 10, list(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [old[i] if i < a else old[a + (i - a) % p] for i in range(len(w))]
    runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = [hashlib.sha256(x).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in runs).encode(),
                                                   b" ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(runs), *best, None if best[1] is None else 1000 * best[1] // best[2], *sha, len(w))


def made_text(rng):
    words = []
    for _ in range(rng.randint(0, 8)):
        base = [rng.choice("a b c dd é".split()) for _ in range(rng.randint(1, 7))]
        words += (base * rng.randint(1, 12))[:rng.randint(1, 50)] + [rng.choice("abcxyz") for _ in range(rng.randint(0, 6))]
    return rng.choice([" ", "\n", "\t "]).join(words)


def test_runs_equal_a_plain_search_over_many_documents_that_share_a_grammar():
    rng = random.Random(3)
    for _ in range(60):
        docs = [made_text(rng).split() for _ in range(rng.randint(1, 8))]
        names = {x: k for k, x in enumerate(sorted({x for d in docs for x in d}))}
        bounds = np.cumsum([0, *map(len, docs)])
        ids = np.array([names[x] for d in docs for x in d], np.int64)
        want = [(s + o, s + n + o, q) for d, o in zip(docs, bounds.tolist()) for s, n, q in sorted(plain_runs(d), key=lambda r: (r[0], r[2]))]
        for exact in (False, True):
            got = find_runs(ids, bounds, exact)
            assert list(zip(*(x.tolist() for x in got))) == want


def test_a_hash_that_lies_is_noticed(monkeypatch):
    monkeypatch.setattr("martkit.llm.periodic_runs._values", lambda ids: np.ones(len(ids), np.uint64))
    ids = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 9, 8, 7, 6, 5, 4] * 2, np.int64)
    got = find_runs(ids, np.array([0, len(ids)]))
    assert [(s, e - s, q) for s, e, q in zip(*(x.tolist() for x in got))] == plain_runs(ids.tolist())
    assert Extensions(ids, exact=True).forward(np.array([0]), np.array([3]), np.array([17])).tolist() == [11]


def test_one_word_a_million_times():
    start, stop, period = find_runs(np.zeros(1 << 20, np.int64), np.array([0, 1 << 20]))
    assert (start.tolist(), stop.tolist(), period.tolist()) == ([0], [1 << 20], [1])


def test_report_equals_a_plain_version(frame, edge_rows):
    rng = random.Random(5)
    rows = edge_rows + [(100 + i, made_text(rng)) for i in range(120)] + [(500, "again " * 40), (500, "again " * 40), (501, "la " * 3000)]
    got = run_report(frame(rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_row(r[0], r[1])) for r in rows)


def test_texts_and_spans_without_seed(frame):
    row = collapse_runs(frame([(10, "so x y x y x y x y end")])).first()
    assert (row.collapsed, [tuple(r) for r in row.runs], row.n_words) == ("so x y end", [(1, 8, 2)], 10)
    assert collapse_runs(frame([])).count() == 0
