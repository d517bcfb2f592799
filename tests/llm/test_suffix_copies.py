"""Repeated passages of a text with thousands of exact copies: one of them goes to a shard."""

from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm import suffix_dedup
from test_suffix_surrogates import plain_removal


def test_copies_do_not_meet_in_a_shard(spark, frame, monkeypatch):
    made, stored = {}, suffix_dedup.stored

    def kept(df, name):
        made[name] = stored(df, name)
        return made[name]
    monkeypatch.setattr(suffix_dedup, "stored", kept)
    passage = prose(1, 30)
    copy, other = f"{prose(2, 20)} {passage} {prose(3, 20)}", f"{prose(4, 20)} {passage} {prose(5, 20)}"
    rows = {None: other, 0: copy, **{i: copy for i in range(10, 2000)}, 5000: f"{prose(6, 20)} {passage}"}
    want = plain_removal({d: t.encode() for d, t in rows.items()}, 100)
    # The first copy and the text before it also stand in many equal rows.
    docs = frame([*rows.items(), *[(0, copy)] * 500, *[(None, other)] * 500])
    for sizes in ({}, {"shard_group": 1}):
        got = suffix_dedup.remove_repeats(docs, **sizes).collect()
        assert len(got) == len(rows) + 1000
        for r in got:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id], r.doc_id
        per_gram = made["suffix-contents"].groupBy("g").agg(F.count("*").alias("n"), F.max("kinds").alias("kinds")).collect()
        assert per_gram and all(r.n <= r.kinds <= 3 for r in per_gram)


def test_workers_get_small_batches(spark, monkeypatch):
    def refusing(run):
        def task(batches):
            def told():
                for b in batches:
                    if b.num_rows > 1000:
                        raise ValueError(f"a batch of {b.num_rows} rows")
                    yield b
            yield from run(told())
        return task
    monkeypatch.setattr(suffix_dedup, "released", refusing)
    passage = "p" * 40 + "q" * 40 + "r" * 40
    docs = spark.createDataFrame([(i, passage if i in (5, 2000) else f"text {i}") for i in range(2500)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs.coalesce(1)).filter("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed) for r in got] == [(2000, 120)]


def test_workers_of_every_stage_get_small_batches_and_give_memory_back(spark, monkeypatch):
    from martkit.llm.queries import QUERIES
    import tempfile

    def refusing(run):
        def task(batches):
            def told():
                for b in batches:
                    if b.num_rows > 1000:
                        raise ValueError(f"a batch of {b.num_rows} rows")
                    yield b
            for out in run(told()):
                # No whole text comes back but those that ranges may be cut from.
                if "text" in out.schema.names and out.num_rows > 10:
                    raise ValueError(f"{out.num_rows} texts")
                yield out
        return task
    monkeypatch.setattr(suffix_dedup, "released", refusing)
    passage = "p" * 40 + "q" * 40 + "r" * 40
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [(i, passage if i in (5, 2000) else f"text {i}") for i in range(2500)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op2_induced_suffix_dedup"](spark, folder).collect()
    assert len(got) == 2500 and [(r.doc_id, r.n_removed) for r in got if r.n_removed] == [(2000, 120)]


def test_anchors_of_texts_do_not_depend_on_blocks(monkeypatch):
    import numpy as np

    raws = [prose(i, 1 + 60 * i).encode() for i in range(8)] + [b"", b"a" * 400, "é".encode() * 300]
    anchors, bounds = suffix_dedup.Anchors(100), np.cumsum([0, *map(len, raws)])
    joined = np.frombuffer(b"".join(raws), np.uint8)
    hashes, places = anchors.find(joined, bounds)
    alone = [(h, p + at) for raw, at in zip(raws, bounds) for h, p in zip(*(
        x.tolist() for x in anchors.find(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))))]
    assert [*zip(hashes.tolist(), places.tolist())] == alone
    for block in (1, 7, 1000):
        monkeypatch.setattr(suffix_dedup, "ANCHOR_BLOCK", block)
        again = anchors.find(joined, bounds)
        assert (again[0] == hashes).all() and (again[1] == places).all()
