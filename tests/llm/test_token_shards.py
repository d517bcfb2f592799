"""Ids read back from the shards are those of the library; keys are found by their hash."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest_llm import prose
from martkit.llm import token_shards
from martkit.llm.token_shards import Encoder, PerfectHash, ShardIndex, ShardSet, read_digests, write_shards
from martkit.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
with open(PATH, encoding="utf-8") as _f:
    DEFINITION = _f.read()
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(DEFINITION, 2, by_word=True)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    [" ", "\n", "\x1c", ".", ",", "...", "'s", "Σ", "İ", "é", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "_", "1.5"])), max_size=12))
def test_words_one_by_one_are_the_whole(parts):
    text = "".join(parts)
    text = "".join(c for c in text if not 0xD800 <= ord(c) <= 0xDFFF)
    assert np.frombuffer(next(ENCODER([text])), "<u2").tolist() == ids(text)


def test_edge_rows_in_several_shards(spark, frame, edge_rows):
    rows = [*edge_rows, *[(100 + i, prose(i)) for i in range(50)], *[(77, prose(i)) for i in range(40)]]
    for shards in (1, 5):
        root = scratch_path(spark, "tokens")
        manifest = write_shards(frame(rows), root, DEFINITION, 2, by_word=True, shards=shards)
        got = read_digests(spark, root).orderBy("start").collect()
        assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
        assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)
        start = 0
        for r in got:
            assert r.start == start
            start += r.n_tokens
        want = sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in (ids(r[1]) for r in rows))
        assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
        shard_set = ShardSet(root)
        assert [x.tolist() for x in shard_set.get(4)] == [ids(edge_rows[4][1])]
        assert sorted(x.tolist() for x in shard_set.get(77)) == sorted(ids(prose(i)) for i in range(40))
        assert shard_set.get(6) == [] and shard_set.get(10**9) == []
    root = scratch_path(spark, "tokens")
    write_shards(frame(rows).limit(0), root, DEFINITION, 2)
    assert read_digests(spark, root).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_perfect_and_minimal(n):
    keys = np.random.default_rng(n).integers(-2**63, 2**63 - 1, n)
    keys = np.unique(keys)
    numbers = PerfectHash.build(keys.view(np.uint64)).find(keys.view(np.uint64))
    assert sorted(numbers) == list(range(len(keys)))
    index = ShardIndex.from_bytes(ShardIndex.build(keys, 0, np.ones(len(keys), np.int64), 2).to_bytes())
    first, count = index.find(keys)
    assert (count == 1).all() and first.tolist() == list(range(len(keys)))
    strangers = np.setdiff1d(np.arange(1000), keys)
    assert not index.find(strangers)[1].any()


def test_workers_get_small_batches(spark, frame, monkeypatch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def refusing(run):
        def task(batches):
            def told():
                for b in batches:
                    if b.num_rows > 1000:
                        raise ValueError(f"a batch of {b.num_rows} rows")
                    yield b
            yield from run(told())
        return task
    monkeypatch.setattr(token_shards, "released", refusing)
    manifest = write_shards(frame([(i, f"word {i}") for i in range(2500)]), scratch_path(spark, "tokens"), DEFINITION, 2,
                            by_word=True, shards=1)
    assert manifest.first().n_docs == 2500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_less_memory_gives_the_same_ids():
    values = [prose(i) for i in range(300)]
    small = Encoder(DEFINITION, 2, by_word=True, memory=5_000)
    assert [np.frombuffer(x, "<u2").tolist() for x in small(values)] == [ids(v) for v in values]
    assert len(small._known) < len({w for v in values for w in v.lower().split()})
