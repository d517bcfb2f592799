"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is a bag of sentences.  A sentence has the features of its distinct words (the word
and its first three, four and five letters) and a logistic score; the document's score is their
noisy-or, 1 - product of (1 - score).  The weights are fitted to document labels alone by
gradient steps through the noisy-or, and then tell which sentences made a document toxic.

The fit reads a bounded sample of labelled documents; features are counted and gradients summed
by Spark over its partitions, and the driver holds one weight per feature.  Scoring is one pass
over whole texts without a shuffle.

Null and empty texts have no sentence and score 0.  Labels other than 0 and 1 and null ids are not
learned from; with labels of one class or none the score of every text with a word is the smoothed
share of label 1.  Repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.base import Shared, fold, labelled_sample, stored, texts

TRAIN_ROWS = 8_000
FEATURES = 400
STEPS = 60
FOLDS = 3
#: Words whose weight a task remembers; then it starts anew.
MEMORY_WORDS = 500_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Where the sentences are: runs without a full stop, mark or line end that hold a word."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(text, *m.span())]


def word_features(word: str) -> set[str]:
    return {"=" + word, *(word[:n] for n in (3, 4, 5) if len(word) >= n)}


@dataclass
class ToxicModel:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    constant: float | None = None
    _known: dict[str, float] = field(default_factory=dict)

    def word_weight(self, word: str) -> float:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= MEMORY_WORDS:
                self._known.clear()
            # In a fixed order, so that sums agree in every run.
            found = self._known[word] = sum(self.weights.get(f, 0.0) for f in sorted(word_features(word)))
        return found

    def sentence_score(self, sentence: str) -> float:
        z = self.bias + sum(map(self.word_weight, sorted(set(_WORD.findall(sentence)))))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def score(self, text: str) -> float:
        low = text.lower()
        words = set(_WORD.findall(low))
        if not words:
            return 0.0
        if self.constant is not None:
            return self.constant
        telling = {w for w in words if self.word_weight(w)}
        log_clean, plain = 0.0, 0
        if telling:
            for a, b in sentences(low):
                found = telling.intersection(_WORD.findall(low, a, b))
                if found:
                    z = self.bias + sum(self.word_weight(w) for w in sorted(found))
                    log_clean -= np.logaddexp(0, z)
                else:
                    plain += 1
        else:
            plain = len(sentences(low))
        log_clean -= plain * np.logaddexp(0, self.bias)
        return float(-np.expm1(log_clean))


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, labels = [], []
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            own = set().union(*map(word_features, set(_WORD.findall(text.lower()))))
            names.extend(own)
            labels.extend([y] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(labels, pa.int32())], names=["f", "y"])


def choose_features(sample: DataFrame, positives: int, rows: int, features: int) -> list[str]:
    """Features that tell toxic documents from others, by likelihood ratio.

    One in a hundred of the toxic documents, and three at least, must hold a feature: rarer ones
    would be learned by heart.
    """
    counts = sample.mapInArrow(_document_features, "f string, y int").groupBy("f").agg(
        F.sum("y").alias("pos"), F.count("*").alias("n"))
    base = (rows - positives + 0.5) / (positives + 0.5)
    lift = F.log((F.col("pos") + 0.5) / (F.col("n") - F.col("pos") + 0.5) * base)
    ranked = counts.filter((F.col("pos") >= max(3, positives // 100)) & (lift > 1)).orderBy((F.col("pos") * lift).desc(), "f")
    return [r["f"] for r in ranked.limit(features).select("f").collect()]


def _pack(shared: Shared):
    """One row per partition: its bags as flat arrays (sentence of each feature, bag of each sentence, labels)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        feats, owner, bag, labels, plain = [], [], [], [], []
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                low, empty = text.lower(), 0
                for a, b in sentences(low):
                    found = [ids[f] for w in set(_WORD.findall(low, a, b)) for f in word_features(w) if f in ids]
                    if found:
                        feats.extend(found)
                        owner.extend([len(bag)] * len(found))
                        bag.append(len(labels))
                    else:
                        empty += 1
                labels.append(y)
                plain.append(empty)
        if labels:
            packed = pickle.dumps([np.array(x, np.int64) for x in (feats, owner, bag, labels, plain)])
            yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["packed"])
    return run


def _gradient(shared: Shared):
    """Loss and its slopes for the weights and the bias, summed over the partition's bags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for packed in batch.column("packed").to_pylist():
                feats, owner, bag, labels, plain = pickle.loads(packed)
                z = bias + np.bincount(owner, weights[feats], minlength=len(bag))
                p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
                log_clean = -(np.bincount(bag, np.logaddexp(0, z), minlength=len(labels)) + plain * np.logaddexp(0, bias))
                toxic = np.maximum(-np.expm1(log_clean), 1e-12)
                # d loss / d log_clean: 1 - clean bags push it up, toxic ones down.
                pull = np.where(labels == 1, np.exp(log_clean) / toxic, -1.0)
                by_sentence = -pull[bag] * p
                slope = np.bincount(feats, by_sentence[owner], minlength=len(weights))
                to_bias = by_sentence.sum() - (pull * plain).sum() * p0
                loss = -np.where(labels == 1, np.log(toxic), log_clean).sum()
                row = np.concatenate([slope, [to_bias, loss]])
                yield pa.RecordBatch.from_arrays([pa.array([row.tobytes()], pa.binary())], names=["row"])
    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None,
                 train_rows: int = TRAIN_ROWS, features: int = FEATURES, steps: int = STEPS,
                 decay: float = 0.0001, rate: float = 0.3) -> ToxicModel:
    """Learn from at most ``train_rows`` labelled documents (the documented bound of the fit)."""
    spark = docs.sparkSession
    # Equal texts count once; where their labels differ, label 1 holds, however the rows are dealt.
    sample = stored(labelled_sample(docs, labels, label, F.lit(True) if keep is None else keep, train_rows)
                    .groupBy("text").agg(F.max("y").alias("y")), "toxicity-sample")
    counts = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    rows, positives = sum(counts.values()), counts.get(1, 0)
    names = choose_features(sample, positives, rows, features) if len(counts) == 2 else []
    if not names:
        return ToxicModel(0.0, constant=(positives + 1) / (rows + 2))
    ids = Shared(spark, {f: i for i, f in enumerate(names)})
    packed = stored(sample.coalesce(8).mapInArrow(_pack(ids), "packed binary"), "toxicity-bags")
    weights, bias = np.zeros(len(names)), -4.0
    state = np.concatenate([weights, [bias]])
    first, second = np.zeros(len(state)), np.zeros(len(state))
    for step in range(1, steps + 1):
        parts = packed.mapInArrow(_gradient(Shared(spark, (state[:-1], float(state[-1])))), "row binary").collect()
        # Partitions are summed in a fixed order: equal inputs give equal models.
        total = np.sum(sorted((np.frombuffer(p["row"]) for p in parts), key=lambda r: r.tobytes()), axis=0)
        slope = total[:-1] / rows
        slope[:-1] += decay * state[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        state = state - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return ToxicModel(float(state[-1]), dict(zip(names, map(float, state[:-1]))))


def _score(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])
    return run


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.7, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    rows = texts(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score(Shared(docs.sparkSession, model)), f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _offending(shared: Shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for a, b in sentences(text) if model.constant is None else []:
                    score = model.sentence_score(text[a:b].lower())
                    if score >= threshold:
                        out.append((doc, a, b, text[a:b], float(score)))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (batch.schema.field("doc_id").type, pa.int64(), pa.int64(),
                                                          pa.string(), pa.float64()))],
                names=["doc_id", "start", "end", "sentence", "score"])
    return run


def toxic_sentences(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The sentences that make documents toxic, with their place (characters) and score."""
    rows = texts(docs, "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_offending(Shared(docs.sparkSession, model), threshold),
                           f"doc_id {kind}, start bigint, end bigint, sentence string, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Fit on the folds that may be learned from, then score every document."""
    model = fit_toxicity(docs, labels, "toxic", fold(F.col("doc_id"), FOLDS) != 1)
    return score_toxicity(docs, model, threshold)
