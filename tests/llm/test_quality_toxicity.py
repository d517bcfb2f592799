"""Classifiers: separable labels are learned, edge cases have scores, folds are kept apart."""

import zlib

import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm.quality_rules import RuleModel, fit_rules, keep_quality, quality_scores, score_quality
from martkit.llm.toxicity import ToxicModel, fit_toxicity, score_toxicity, toxic_sentences, toxicity_scores


@pytest.fixture(scope="module")
def corpus(spark, frame):
    bad = {i: " | ".join(prose(i, 40).split()) if i % 5 == 0 else None for i in range(300)}
    rude = {i: prose(i + 1000, 12) + " You moronic fool. " + prose(i + 2000, 9) if i % 4 == 1 else None for i in range(300)}
    rows = [(i, bad[i] or rude[i] or prose(i, 40)) for i in range(300)]
    labels = spark.createDataFrame([(i, int(not bad[i]), int(rude[i] is not None)) for i in range(300)],
                                   "doc_id long, quality int, toxic int")
    return frame(rows), labels


def share_right(scores, labels, label):
    rows = scores.filter("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col(label)).cast("int").alias("ok"))
    return rows.agg(F.avg("ok")).first()[0]


def test_quality_on_held_out_rows(corpus):
    docs, labels = corpus
    scores = quality_scores(docs, labels)
    assert share_right(scores, labels, "quality") == 1
    for r in scores.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 240


def test_toxicity_on_held_out_rows(corpus):
    docs, labels = corpus
    scores = toxicity_scores(docs, labels)
    assert share_right(scores, labels, "toxic") >= 0.95
    for r in scores.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    model = fit_toxicity(docs, labels)
    found = toxic_sentences(docs, model).collect()
    assert {r.doc_id for r in found} == {i for i in range(300) if i % 4 == 1 and i % 5}
    assert all("moronic" in r.sentence for r in found)


def test_edge_rows_and_one_class(spark, frame, edge_rows, corpus):
    docs, (_, labels) = frame(edge_rows), corpus
    one = spark.createDataFrame([(3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    none = one.limit(0)
    for table in (one, none):
        assert {r.predicted for r in quality_scores(docs, table).collect()} == {1}
        model = fit_toxicity(docs, table)
        assert model.constant is not None
        scores = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
        assert scores[1] == scores[2] == scores[7] == 0
    model = RuleModel(0.5)
    assert score_quality(docs, model).count() == len(edge_rows)
    assert score_quality(docs.limit(0), model).count() == 0
    assert score_toxicity(docs.limit(0), ToxicModel(-1.0)).count() == 0


def test_rules_read_as_conjunctions(corpus):
    docs, labels = corpus
    model = fit_rules(docs, labels)
    assert model.rules and all(w for w in model.weights)
    assert any("bars" in str(r) for r in model.rules)
