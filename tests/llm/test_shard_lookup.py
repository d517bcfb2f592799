"""Lookups that seek give the ids of the whole-index lookup, and read a few values a key."""

import numpy as np
import public_tokenizers

from conftest_llm import prose
from martkit.llm import shard_lookup
from martkit.llm.shard_lookup import KeyedShards
from martkit.llm.token_shards import ShardSet, write_shards
from martkit.session import scratch_path

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as _f:
    DEFINITION = _f.read()


def test_lookups_by_seeking(spark, frame, edge_rows, monkeypatch):
    rows = [*edge_rows, *[(i * 3 - 600, prose(i % 50, 8)) for i in range(2000)], *[(77, prose(i)) for i in range(40)]]
    root = scratch_path(spark, "tokens")
    write_shards(frame(rows), root, DEFINITION, 2, by_word=True, shards=4)
    whole, keyed = ShardSet(root), KeyedShards(root, opened=2)
    reads = []
    plain = shard_lookup._Field.read
    monkeypatch.setattr(shard_lookup._Field, "read", lambda self, at, count=1: reads.append(count) or plain(self, at, count))
    most = 0
    for key in [-10**12, -600, -599, 0, 3, 5, 77, 1, 2, 8, 3000, 5397, 10**12]:
        want, before = whole.get(key), len(reads)
        got = keyed.get(key)
        assert [x.tolist() for x in got] == [x.tolist() for x in want]
        assert len(keyed._open) <= 2
        most = max(most, len(reads) - before)
    # A word of each level, rank, fingerprint, place, key, count, offsets, and what opening a shard reads.
    assert most <= 40 and max(reads) <= 64
    assert np.concatenate(keyed.get(77)).dtype.itemsize == 2
    keyed.close()
    root = scratch_path(spark, "tokens")
    write_shards(frame(rows).limit(0), root, DEFINITION, 2)
    assert KeyedShards(root).get(1) == []
