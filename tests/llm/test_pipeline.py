"""The pipeline against plain versions of its stages, stage by stage, each on its own input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest_llm import prose
from martkit.llm.decontaminate import cut_words, words_of
from martkit.llm.mixture import mixture
from martkit.llm.quality_rules import quality_scores
from martkit.session import scratch_path
from test_decontaminate import plain
from test_pairs import near, plain_groups
from test_token_shards import ids


@pytest.fixture(scope="module")
def corpus(spark, frame):
    """A folder with documents, labels and benchmark, as the given tables have them."""
    passage = prose(5000, 25)
    rows = []
    for i in range(160):
        text = prose(i, 40 + i % 30)
        if i % 8 == 0:
            text = " | ".join(text.split())
        elif i % 10 == 1:
            text = near(prose(77, 80), i, 1)
        elif i % 16 == 2:
            text = f"{prose(i, 30)} {passage} {prose(i + 1, 20)}"
        elif i % 16 == 3:
            text = passage
        rows.append((i, text, f"s{i % 3}"))
    rows += [(200, None, None), (201, "", "s1"), (202, prose(3, 43), "s0")]
    folder = scratch_path(spark, "corpus")
    frame(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 != 0), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, prose(6000, 20))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return [(r.doc_id, r.text, r.source, r.n_chars) for r in df.collect()]


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs
        path = scratch_path(spark, name)
        stage(spark, docs, corpus).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    good = {r.doc_id for r in quality_scores(kept["quality"], labels).collect() if r.predicted}
    assert {r[0] for r in rows_of(kept["near_copies"])} == good and not {i for i in good if i < 160 and i % 8 == 0}

    rows = rows_of(kept["near_copies"])
    _, root = plain_groups([(d, t or "") for d, t, *_ in rows])
    first = {}
    for (d, *_), r in zip(rows, root):
        first[r] = min(first.get(r, d), d)
    assert sorted(r[0] for r in rows_of(kept["benchmark_text"])) == sorted(first.values())

    items = [(r.item_id, words_of(r.text)) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    want = {}
    for d, t, s, n in rows_of(kept["benchmark_text"]):
        hit, _ = plain(words_of(t), items, 10)
        if len(hit) * 2 <= len(words_of(t)):
            spans = [[j, j + 1] for j in sorted(hit)]
            runs = []
            for a, b in spans:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
            new = cut_words(t, runs) if runs else t
            want[d] = (d, new, s, len(new) if runs else n)
    assert {r[0]: r for r in rows_of(kept["source_weights"])} == want

    copies = {r.doc_id: r.copies for r in mixture(kept["source_weights"]).collect()}
    mixed = rows_of(kept["token_ids"])
    assert len(mixed) == sum(copies.values()) and all(
        sum(1 for r in mixed if r[0] == d) == n for d, n in copies.items())

    encoded = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in docs.collect())
    plain_ids = [(d, ids(t)) for d, t, *_ in mixed]
    assert encoded == sorted((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in plain_ids)
    start = 0
    for r in docs.orderBy("start").collect():
        assert r.start == start
        start += r.n_tokens
    ran = corpus_pipeline.run(spark, corpus)
    assert ran.agg(F.sum("n_tokens"), F.bit_xor("ids_crc32")).first() == docs.agg(F.sum("n_tokens"), F.bit_xor("ids_crc32")).first()
