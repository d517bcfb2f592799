"""Line dedup of short lines, as op6 runs it, against a plain version."""

import random

from conftest_llm import prose
from martkit.llm import line_dedup
from martkit.llm.queries import QUERIES
from martkit.session import scratch_path
from test_pairs import distance, edited


def plain(rows):
    lines = {}
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if line:
                lines.setdefault(line, set()).add((-1 if doc is None else doc, pos))
    names, root = list(lines), {x: x for x in lines}
    for i, a in enumerate(names):
        for b in names[:i]:
            least = min(len(a), len(b))
            edits = 2 if least >= 24 else 1 if least >= 12 else 0
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                x, y = root[a], root[b]
                root = {k: x if r == y else r for k, r in root.items()}
    first = {}
    for line, places in lines.items():
        first[root[line]] = min(first.get(root[line], min(places)), min(places))
    return {(d, p) for line, places in lines.items() for d, p in places if (d, p) != first[root[line]]}


def test_short_lines(spark, frame, edge_rows):
    rng = random.Random(4)
    pool = ["Les.", "And ornd.", "Of, edti oner.", "a" * 11, "a" * 12, "ab" * 6, "x" * 23, "b" * 24, "é" * 13, " ", "\t"]
    pool += [prose(i, 2) for i in range(12)] + [prose(i, 3)[:24] for i in range(12)] + [prose(50 + i, 6) for i in range(5)]
    rows = [(10 + i, "\n".join(edited(rng, rng.choice(pool), rng.choice([0, 0, 0, 1, 2])) for _ in range(8))) for i in range(60)]
    rows += [(r[0], r[1]) for r in edge_rows]
    gone = plain(rows)
    docs = frame(rows)
    got = line_dedup.line_report(docs, short=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert sorted(p for d, p in gone if d == (-1 if r.doc_id is None else r.doc_id)) == list(r.removed_lines), r.doc_id
    texts = {r.doc_id: r.text for r in line_dedup.drop_lines(docs, short=True).collect()}
    for doc, text in rows[:60]:
        assert texts[doc] == "\n".join(x for p, x in enumerate(text.split("\n")) if (doc, p) not in gone)


def test_query_removes_short_copies(spark, frame):
    folder = scratch_path(spark, "short-lines")
    frame([(1, "Les.\nOne\n\n"), (2, "Les.\nTwo\n"), (3, "Les.")]).write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: list(r.removed_lines) for r in QUERIES["op6_line_edit_join"](spark, folder).collect()}
    assert got == {1: [], 2: [0], 3: [0]}


def test_many_lines_with_a_common_segment(spark, monkeypatch):
    """Lines that share a beginning meet on more of their text; what is linked stays what plain comparison links."""
    rng = random.Random(8)
    start = "the same beginning of very many lines, which says nothing "
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(40)]
    lines = {start + " ".join(rng.choice(words) for _ in range(5)) for _ in range(60)}
    for line in sorted(lines)[:30]:
        for edits in (1, 2, 2, 3):
            chars = list(line)
            for _ in range(edits):
                at, kind = rng.randrange(len(chars)), rng.randrange(3)
                chars[at:at + 1] = [[], [rng.choice("xyzé")], [chars[at], rng.choice("xyzé")]][kind]
            lines.add("".join(chars))
    lines = sorted(lines)
    made = []
    near = line_dedup.near_links
    monkeypatch.setattr(line_dedup, "near_links", lambda a, pairs, t=2: made.append(pairs.count()) or near(a, pairs, t))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in line_dedup.repeated_lines(docs).collect()}
    first = list(range(len(lines)))

    def top(i):
        while first[i] != i:
            i = first[i]
        return i
    for i, a in enumerate(lines):
        for j in range(i):
            if abs(len(a) - len(lines[j])) <= 2 and distance(a, lines[j]) <= 2:
                x, y = sorted((top(i), top(j)))
                first[y] = x
    assert sorted(got) == [i for i in range(len(lines)) if top(i) != i]
    for i in got:
        assert (got[i] in {got[j] for j in got if top(j) == top(i)})
    # The lines that share the beginning: against the first one each, and then the pairs that may still join classes.
    assert len(made) == 3 and made[1] + made[2] < len(lines)
