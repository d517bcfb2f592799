"""Hits of the automaton are those of a plain search for every window."""

import hashlib
import re

from hypothesis import given, settings, strategies as st

from conftest_llm import prose
from martkit.llm.decontaminate import Automaton, contamination, cut_words, decontaminate, words_of

_PLAIN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(words, items, window):
    hit, found = set(), set()
    for item, own in items:
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == own[k:k + size]:
                    hit.update(range(j, j + size))
                    found.add(item)
    return hit, found


SEQUENCE = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14)


@settings(max_examples=400, deadline=None)
@given(st.lists(SEQUENCE, max_size=4), SEQUENCE, st.integers(1, 5))
def test_automaton_against_plain_search(texts, words, window):
    items = list(enumerate(texts))
    spans, found = Automaton([i for i in items if i[1]], window).match(words)
    assert ({j for a, b in spans for j in range(a, b)}, found) == plain(words, items, window)


@given(st.text(max_size=40))
def test_words(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [w.decode() for w in words_of(text)] == _PLAIN.findall(text.translate(_LOWER))


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, spans string")


def test_edge_rows(spark, frame, edge_rows):
    passage = prose(50, 30)
    items = benchmark(spark, [(1, passage, ""), (10, passage, ""), (2, "word", ""), (3, None, ""), (4, "", ""), (5, "--", "")])
    rows = [*edge_rows, (20, f"{prose(1)} {passage.replace("a", "A")} {prose(2)}"), (21, prose(1))]
    got = {(r.doc_id, r.n_words): r for r in contamination(frame(rows), items).collect()}
    assert sum(1 for _ in contamination(frame(rows), items).collect()) == len(rows)
    hit = got[20, 150]
    assert (hit.n_hit, hit.n_items, hit.contaminated) == (30, 2, True)
    assert hit.items_sha256 == hashlib.sha256(b"1,10").hexdigest()
    assert (got[8, 1].n_hit, got[8, 1].n_items) == (1, 1)
    assert all(not r.contaminated for k, r in got.items() if k[0] not in (8, 20))
    assert got[1, 0].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert contamination(frame(rows).limit(0), items).count() == 0
    assert not any(r.contaminated for r in contamination(frame(rows), items.limit(0)).collect())
    # Several automata give what one gives.
    import martkit.llm.decontaminate as module
    from martkit.llm.base import texts
    one = module.find_items(texts(frame(rows), "doc_id"), items)
    many = module.find_items(texts(frame(rows), "doc_id"), items, shard_words=20)
    key = ["doc_id", "n_words", "spans", "items"]
    assert sorted(map(repr, one.select(*key).collect())) == sorted(map(repr, many.select(*key).collect()))


def test_spans_are_cut(spark, frame):
    passage = prose(50, 30)
    docs = frame([(1, f"{prose(1)} {passage} {prose(2)}"), (2, passage), (3, prose(3))])
    out = {r.doc_id: r for r in decontaminate(docs, benchmark(spark, [(1, passage, "")])).collect()}
    assert set(out) == {1, 3} and decontaminate(docs, benchmark(spark, [(1, passage, "")])).columns == docs.columns
    assert out[1].text == f"{prose(1)} . {prose(2)}" and out[1].n_chars == len(out[1].text)
    assert out[3].text == prose(3) and out[3].rid == "rid"
    assert cut_words("Ünï a-b c", [[0, 1], [2, 3]]) == " a- c"


def test_one_worker_finds_and_cuts(spark, frame):
    passage = prose(50, 30)
    rows = [(1, f"{prose(1, 80)} {passage} {prose(2, 80)}"), (2, None), (3, ""), (4, prose(3)), (5, passage)]
    out = decontaminate(frame(rows), benchmark(spark, [(1, passage, "")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    kept = f"{prose(1, 80)} {prose(2, 80)}"
    assert words_of(got[1][0]) == words_of(kept) and got[1][1] == len(got[1][0])
    assert {k: v[0] for k, v in got.items() if k != 1} == {2: None, 3: "", 4: prose(3)}
