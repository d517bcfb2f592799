"""Targets are met where rows repeat or have no id, and sizes and copies equal plain ones."""

import re

import pytest

from conftest_llm import prose
from martkit.llm.mixture import MOST, mix, mixture


@pytest.mark.parametrize("doc_id", [None, 7])
def test_repeated_rows_and_null_ids_meet_the_target(frame, doc_id):
    rows = [(doc_id, "one two three four five six seven eight nine ten " * 6, "a")] * 2000
    rows += [(1000 + i, prose(i, 40 + i), "b") for i in range(300)]
    docs = frame(rows).repartition(6)
    got = mixture(docs).collect()
    source = {r[0]: r[2] for r in rows}
    for s in "ab":
        own = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own), s
    copies = {r.copies for r in got if r.doc_id == doc_id}
    assert max(copies) - min(copies) == 1 and all(r.taken <= MOST * r.size for r in got)
    made = mix(docs)
    assert made.columns == docs.columns
    assert made.filter("source = 'a'").count() == sum(r.copies for r in got if r.doc_id == doc_id)


def test_sizes_and_copies_equal_plain_ones(frame, edge_rows):
    rows = [(1000 + i, prose(i, 5 + i * 37 % 90), "xyz"[i % 3]) for i in range(200)] + [(r[0], r[1], "e") for r in edge_rows]
    rows += [(5000, "a\u00a0b c\x0bd", "x"), (None, "no id but words", "y"), (None, "no id and other words", "y")]
    docs = frame(rows)
    size = {(r[0], r[1]): len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    per_source = {}
    for r in rows:
        per_source[r[2]] = per_source.get(r[2], 0) + size[r[0], r[1]]
    got = mixture(docs).collect()
    assert sorted(r.size for r in got) == sorted(size[r[0], r[1]] for r in rows)
    source = {r[0]: r[2] for r in rows if r[0] is not None}
    assert all(r.source_size == per_source[source[r.doc_id]] for r in got if r.doc_id is not None)
    # The mixed corpus holds every row as often as the report says.
    made, said = {}, {}
    for r in mix(docs).collect():
        made[r.doc_id] = made.get(r.doc_id, 0) + 1
    for r in got:
        assert r.taken == r.size * r.copies
        said[r.doc_id] = said.get(r.doc_id, 0) + r.copies
    assert made == {k: n for k, n in said.items() if n}
    again = {(r.doc_id, r.size, r.copies) for r in mixture(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.size, r.copies) for r in got}
