"""Similarity joins and line dedup against plain versions, with groups that must be split."""

import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm import jaccard, line_dedup
from martkit.llm.components import components
from martkit.llm.decontaminate import words_of


def shingles(text):
    words = words_of(text)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_groups(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    return links, root


def near(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_and_links(spark, frame, edge_rows, monkeypatch):
    # Small limits, so that buckets are split and blocks are compared.
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    base = prose(1, 300)
    shared = prose(2, 40)
    rows = [(100 + i, near(base, i, i % 6)) for i in range(60)]
    rows += [(300 + i, prose(1000 + i, 40) + " " + shared) for i in range(40)]
    rows += [(400 + i, prose(500 + i // 2, 60 + i % 2)) for i in range(40)]
    rows += [(r[0], r[1]) for r in edge_rows if r[0] is not None]
    docs = frame([*rows, (None, prose(6))])
    links, root = plain_groups(rows)
    got = {}
    for r in jaccard.jaccard_groups(docs).collect():
        got.setdefault(r.doc_id, (r.class_id, r.n_links))
    firsts = {}
    for (doc, _), r in zip(rows, root):
        firsts[r] = min(firsts.get(r, doc), doc)
    for (doc, _), n, r in zip(rows, links, root):
        assert got[doc] == (firsts[r], n), doc
    assert got[None] == (None, 0)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(set(firsts.values()))
    assert jaccard.jaccard_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.member: r.root for r in components(df).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars) + 1), rng.random()
        if kind < 0.4:
            chars.insert(at, rng.choice("abé "))
        elif at < len(chars):
            chars[at:at + 1] = [] if kind < 0.7 else [rng.choice("abxé")]
    return "".join(chars)


def test_banded_distance(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(3, 30)))
        b = edited(rng, a, rng.randrange(5))
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) <= 2:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), 2).alias("ok")).collect()
    assert [r.ok for r in got] == [distance(r.a, r.b) <= 2 for r in got]


def test_lines_against_plain_version(spark, frame, edge_rows):
    rng = random.Random(3)
    pool = [prose(i, 6) for i in range(25)] + ["short", "x" * 40, "a" * 23]
    rows = [(10 + i, "\n".join(edited(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 4])) for _ in range(6))) for i in range(60)]
    rows += [(r[0], r[1]) for r in edge_rows]
    docs = frame(rows)
    lines = {}
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if len(line) >= 24:
                lines.setdefault(line, set()).add((-1 if doc is None else doc, pos))
    names, root = list(lines), {x: x for x in lines}
    for i, a in enumerate(names):
        for b in names[:i]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                x, y = root[a], root[b]
                root = {k: x if r == y else r for k, r in root.items()}
    first = {}
    for line, places in lines.items():
        first[root[line]] = min(first.get(root[line], min(places)), min(places))
    gone = {(d, p) for line, places in lines.items() for d, p in places if (d, p) != first[root[line]]}
    got = line_dedup.line_report(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        doc = -1 if r.doc_id is None else r.doc_id
        assert sorted(p for d, p in gone if d == doc) == list(r.removed_lines)
        assert r.n_removed == len(r.removed_lines)
    assert {r.doc_id: r.n_lines for r in got}[1] == 0
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[2] == ""
    for doc, text in rows[:60]:
        assert texts[doc] == "\n".join(x for p, x in enumerate(text.split("\n")) if (doc, p) not in gone)
    assert line_dedup.line_report(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_sets_do_not_depend_on_the_batch(values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    hashes, bounds = jaccard.shingle_sets(values)
    for i, v in enumerate(values):
        own, _ = jaccard.shingle_sets([v])
        assert hashes[bounds[i]:bounds[i + 1]].tolist() == own.tolist()
        assert len(own) == len(shingles(v))
