"""Filters that grow with what they hold, and texts that stand in many documents."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm import suffix_dedup
from test_suffix_surrogates import plain_removal


@pytest.fixture
def made(monkeypatch):
    """What the passes store, by name."""
    out, stored = {}, suffix_dedup.stored

    def kept(df, name):
        out[name] = stored(df, name)
        return out[name]
    monkeypatch.setattr(suffix_dedup, "stored", kept)
    return out


def test_places_of_single_grams_stay_where_they_are(frame, made, monkeypatch):
    # So few bits that the repeated grams of these texts would set nearly all of them.
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 1 << 6)
    passage = prose(1, 200)
    rows = {i: f"{prose(100 + i, 60)} {passage} {prose(300 + i, 60)}" for i in range(20)}
    got = suffix_dedup.remove_repeats(frame(rows.items())).collect()
    want = plain_removal({d: t.encode() for d, t in rows.items()}, 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want
    grams = made["suffix-grams"].withColumnRenamed("g", "its_g")
    repeated = made["suffix-occurrences"].join(grams, F.col("g").bitwiseAND((1 << 48) - 1) == F.col("its_g"), "left_semi")
    n, all_places = repeated.count(), made["suffix-occurrences"].count()
    assert 0 < n <= all_places <= 1.2 * n


def test_a_filter_holds_all_its_keys_and_few_others(spark):
    keys = spark.range(300_000).select(F.xxhash64("id").alias("key"))
    words = suffix_dedup.make_filter(keys, "key", 40_000_000)
    assert 64 * len(words) == 1 << 29
    words = suffix_dedup.make_filter(keys, "key", 300_000)
    assert 64 * len(words) == suffix_dedup.FILTER_BITS
    own = keys.toArrow().column("key").to_numpy().view(np.uint64)
    assert suffix_dedup.in_filter(words, own).all()
    assert suffix_dedup.in_filter(words, suffix_dedup._mix(own)).mean() < 0.01


def test_filters_of_every_size_use_all_their_bits():
    keys = suffix_dedup._mix(np.arange(1_000_000, dtype=np.uint64))
    for bits in suffix_dedup._bits(keys, suffix_dedup.MOST_BITS):
        assert len(np.unique(bits)) > 0.99 * len(keys) and bits.max() > 0.99 * suffix_dedup.MOST_BITS


def test_only_the_first_document_of_a_text_is_looked_through(frame, made):
    copy, short = prose(1, 60), "few words"
    rows = [(None, copy), *[(i, copy) for i in range(1, 6)], (7, f"{prose(2, 30)} {copy}"), (8, short), (9, short), (10, None), (11, ""),
            (12, prose(3, 60)), (12, prose(4, 60)), (13, prose(3, 60)), (13, prose(3, 60))]
    got = suffix_dedup.remove_repeats(frame(rows)).collect()
    assert len(got) == len(rows)
    size = len(copy.encode())
    assert [(r.n_removed, r.n_spans, bytes(r.kept)) for r in got if r.doc_id is None] == [(0, 0, copy.encode())]
    for r in got:
        if r.doc_id in range(1, 6):
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (size, size, 1, b"")
        elif r.doc_id == 7:
            assert (r.n_removed, bytes(r.kept)) == (size, f"{prose(2, 30)} ".encode())
        elif r.doc_id == 13:
            assert (r.n_removed, r.n_spans, bytes(r.kept)) == (r.n_bytes, 1, b"")
        elif r.doc_id is not None:
            assert r.n_removed == 0
    found = made["suffix-occurrences"].select("doc_id").distinct().collect()
    assert {r.doc_id for r in found} == {None, 7}
