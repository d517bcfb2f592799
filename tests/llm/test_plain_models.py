"""The models against plain versions of theirs: noisy-or, its gradient, rules, and labels of equal texts."""

import math
import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm.quality_rules import Rule, RuleModel, fit_rules, score_quality
from martkit.llm.toxicity import ToxicModel, _gradient, _pack, fit_toxicity, score_toxicity, word_features

FEATURES = ["=alpha", "alp", "bet", "gamm", "=deltas", "etaing"]


def noisy_or(model, text):
    clean = 1.0
    for part in re.split(r"[.!?\n]", text.lower()):
        words = set(re.findall(r"\w+", part))
        if words:
            z = model.bias + sum(model.weights.get(f, 0.0) for w in words for f in word_features(w))
            clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_score_is_a_plain_noisy_or(spark, frame, edge_rows):
    rng = random.Random(3)
    model = ToxicModel(-3.0, {f: rng.uniform(-2, 3) for f in FEATURES})
    rows = [(100 + i, ". ".join(prose(10 * i + j, 8) for j in range(i % 6)) + "!\n?") for i in range(60)]
    texts = {r[0]: r[1] or "" for r in [*rows, *edge_rows]}
    got = score_toxicity(frame([*rows, *edge_rows]), model).collect()
    assert len(got) == len(rows) + len(edge_rows)
    for r in got:
        assert math.isclose(r.score, noisy_or(model, texts[r.doc_id]), rel_tol=1e-9, abs_tol=1e-12)


def test_gradient_is_the_slope_of_the_loss():
    texts = [". ".join(prose(10 * i + j, 6) for j in range(1 + i % 4)) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "y": pa.array([i % 2 for i in range(40)], pa.int32())})
    packed = list(_pack(SimpleNamespace(value={f: i for i, f in enumerate(FEATURES)}))(iter([batch])))
    state = np.array([0.3, -0.7, 0.2, 0.9, -0.1, 0.5, -1.5])

    def at(s):
        return np.frombuffer(next(_gradient(SimpleNamespace(value=(s[:-1], float(s[-1]))))(iter(packed))).column("row")[0].as_py())
    slope = at(state)[:-1]
    for i in range(len(state)):
        step = np.zeros(len(state))
        step[i] = 1e-6
        assert math.isclose((at(state + step)[-1] - at(state - step)[-1]) / 2e-6, slope[i], rel_tol=1e-4, abs_tol=1e-6)
    model = ToxicModel(-1.5, dict(zip(FEATURES, state[:-1])))
    loss = -sum(math.log(noisy_or(model, t) if i % 2 else 1 - noisy_or(model, t)) for i, t in enumerate(texts))
    assert math.isclose(at(state)[-1], loss, rel_tol=1e-9)


def test_equal_texts_with_unlike_labels_however_dealt(spark, frame):
    rows = [(i, prose(i % 20, 12) + (" You moronic fool." if i % 20 < 6 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 20 < 6 and i < 40)) for i in range(60)], "doc_id long, toxic int")
    models = [fit_toxicity(frame(rows).repartition(n), labels.repartition(n), steps=5) for n in (1, 3, 7)]
    for other in models[1:]:
        assert other.weights.keys() == models[0].weights.keys() and models[0].weights
        assert all(math.isclose(w, models[0].weights[f], rel_tol=1e-9) for f, w in other.weights.items())


def plain_statistics(text):
    text = (text or "").strip(" ")
    words, lines = text.split(" ") if text else [], text.split("\n")
    n, chars, every = len(words), len(text), text.split(" ")
    def share(part, whole):
        return part / whole if whole > 0 else 0.0
    def count(pattern):
        return len(re.findall(pattern, text))
    return {"chars": math.log1p(chars), "words": math.log1p(n), "word_chars": share(chars - n + 1, n),
            "distinct_words": share(len(set(every)), n), "upper": share(sum(c.isupper() for c in text), chars),
            "digits": share(count("[0-9]"), chars), "symbols": share(count(r"[#$%&*<>{}\[\]~^=_\\/]"), chars),
            "bars": share(count(r"\|"), n), "shouts": share(count("!"), n), "stops": share(count("[.,;:?]"), n),
            "lines": share(len(lines), n), "distinct_lines": share(len(set(lines)), len(lines))}


def plain_quality(model, text):
    stats, z = plain_statistics(text), model.intercept
    for rule, weight in zip(model.rules, model.weights):
        if all((low is None or stats[n] > low) and (high is None or stats[n] <= high) for n, low, high in rule.bounds):
            z += weight
    return 1 / (1 + math.exp(-z))


def test_compiled_rules_equal_rules_read_plainly(spark, frame, edge_rows):
    rows = [(100 + i, prose(i, 5 + i) + (" | # | 12 !" if i % 3 == 0 else "") + ("\nSame\nSame" if i % 4 == 0 else "")) for i in range(80)]
    docs = frame([*rows, *edge_rows])
    labels = spark.createDataFrame([(100 + i, int(i % 3 != 0)) for i in range(80)], "doc_id long, quality int")
    by_hand = RuleModel(0.25, (Rule((("bars", None, 0.01), ("words", 1.5, None))), Rule((("distinct_lines", 0.5, 0.9),)),
                               Rule((("upper", 0.0, None), ("stops", 0.001, 0.2)))), (1.5, -0.75, 0.4))
    texts = {r[0]: r[1] for r in [*rows, *edge_rows]}
    for model in (by_hand, fit_rules(docs, labels)):
        assert model.rules
        for r in score_quality(docs, model).collect():
            assert math.isclose(r.score, plain_quality(model, texts[r.doc_id]), rel_tol=1e-9), (r.doc_id, str(model.rules))


def test_search_is_exact_in_large_numbers_and_per_length(spark):
    from martkit.llm.pivot_search import nearest

    rng = random.Random(5)
    def plain(rows):
        whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
        out = []
        for q, v in whole:
            if q % 50 == 0:
                best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in whole if c != q and len(w) == len(v))[:5]
                out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
        return sorted(out)
    schema = "vec_id long, embedding array<double>"
    for size in (2.0**10, 2.0**19, 2.0**21):
        # Small candidates beside a large query, and the other way round: both sides decide what is exact.
        rows = [(i, [rng.uniform(-1, 1) * (size if i % 3 else 1) for _ in range(6)]) for i in range(120)]
        rows += [(200 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)] + [(350, [1.0])]
        df = spark.createDataFrame(rows, schema).repartition(3)
        assert sorted(map(tuple, nearest(df).collect())) == plain(rows)
    for bad in ([(0, [1e300, 0.0]), (1, [1.0, 1.0])], [(0, [2.0**40, 1.0]), (1, [2.0**40, 1.0])]):
        with pytest.raises(Exception, match="no bigint"):
            nearest(spark.createDataFrame(bad, schema)).collect()
