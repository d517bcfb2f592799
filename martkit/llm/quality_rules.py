"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees grown on the statistics of a bounded labelled sample give conjunctive rules
(every path from a root to a node); a lasso logistic regression keeps few of them;
the kept ones are compiled into one Spark column expression, so scoring a corpus is
a projection in the JVM: no shuffle, no Python.

Nulls and empty texts have statistics of zero and get the score that the rules give
to those.  Labels other than 0 and 1 and null ids are not learned from.  With labels
of one class or none the model has no rules and scores the share of label 1, smoothed.
Repeated rows are scored alike; other columns of the input are never looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.base import fold, labelled_sample, let, stored, texts

TRAIN_ROWS = 20_000
FOLDS = 5

STATISTICS = ("chars", "words", "word_chars", "distinct_words", "upper", "digits", "symbols", "bars",
              "shouts", "stops", "lines", "distinct_lines")


def statistics(text: Column) -> Column:
    """A struct of doubles; shares are per character or per word, zero for an empty text."""
    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    def body(p: Column) -> Column:
        words, lines, t = p["words"], p["lines"], p["text"]
        chars = F.length(t)
        n = F.when(t == "", F.lit(0)).otherwise(F.size(words))
        fields = {
            "chars": F.log1p(chars.cast("double")),
            "words": F.log1p(n.cast("double")),
            "word_chars": share(chars - n + 1, n),
            "distinct_words": share(F.size(F.array_distinct(words)), n),
            "upper": share(F.regexp_count(t, F.lit(r"\p{Lu}")), chars),
            "digits": share(F.regexp_count(t, F.lit("[0-9]")), chars),
            "symbols": share(F.regexp_count(t, F.lit(r"[#$%&*<>{}\[\]~^=_\\/]")), chars),
            "bars": share(F.regexp_count(t, F.lit(r"\|")), n),
            "shouts": share(F.regexp_count(t, F.lit("!")), n),
            "stops": share(F.regexp_count(t, F.lit("[.,;:?]")), n),
            "lines": share(F.size(lines), n),
            "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        }
        return F.struct(*[F.coalesce(fields[name], F.lit(0.0)).alias(name) for name in STATISTICS])

    safe = F.trim(F.coalesce(text, F.lit("")))
    return let(F.struct(safe.alias("text"), F.split(safe, " ").alias("words"),
                        F.split(safe, "\n").alias("lines")), body)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds: ``low < statistic <= high`` for each statistic named."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def holds(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low is not None:
                out = out & (stats[name] > F.lit(low))
            if high is not None:
                out = out & (stats[name] <= F.lit(high))
        return out

    def __str__(self) -> str:
        return " and ".join(
            " < ".join(p for p in (None if low is None else f"{low:g}", name) if p)
            + ("" if high is None else f" <= {high:g}") for name, low, high in self.bounds)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = field(default=())

    def score(self, text: Column) -> Column:
        """Probability of label 1 as one column expression over the text."""
        def logistic(stats: Column) -> Column:
            z = F.lit(float(self.intercept))
            for rule, weight in zip(self.rules, self.weights):
                z = z + F.when(rule.holds(stats), F.lit(float(weight))).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return let(statistics(text), logistic)


def tree_rules(forest) -> list[Rule]:
    """Every path from a root to a node below it, its bounds merged per statistic."""
    found: dict[Rule, None] = {}

    def walk(node, box: dict) -> None:
        if box:
            found[Rule(tuple((n, *box[n]) for n in STATISTICS if n in box))] = None
        if not node.getClass().getSimpleName().startswith("Internal"):
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], float(split.threshold())
        low, high = box.get(name, (None, None))
        walk(node.leftChild(), box | {name: (low, at if high is None else min(at, high))})
        walk(node.rightChild(), box | {name: (at if low is None else max(at, low), high)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None,
              train_rows: int = TRAIN_ROWS, trees: int = 12, depth: int = 3, penalty: float = 0.002,
              seed: int = 7) -> RuleModel:
    """Learn from at most ``train_rows`` labelled rows (the documented bound of the fit)."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if keep is None else keep, train_rows)
    sample = stored(sample.select(F.col("y").cast("double").alias("y"), statistics(F.col("text")).alias("s")),
                    "quality-sample")
    counts = {int(r["y"]): r["count"] for r in sample.groupBy("y").count().collect()}
    ones, rows = counts.get(1, 0), sum(counts.values())
    if len(counts) < 2:
        share = (ones + 1) / (rows + 2)
        return RuleModel(_logit(share))
    data = sample.select("y", "s", array_to_vector(F.array(*[F.col("s")[n] for n in STATISTICS])).alias("x"))
    forest = RandomForestClassifier(labelCol="y", featuresCol="x", numTrees=trees, maxDepth=depth, seed=seed,
                                    minInstancesPerNode=5, featureSubsetStrategy="onethird").fit(data)
    rules = tree_rules(forest)
    if not rules:
        return RuleModel(_logit((ones + 1) / (rows + 2)))
    hits = data.select("y", array_to_vector(F.array(
        *[rule.holds(F.col("s")).cast("double") for rule in rules])).alias("x"))
    lasso = LogisticRegression(labelCol="y", featuresCol="x", elasticNetParam=1.0, regParam=penalty,
                               standardization=False, maxIter=100).fit(hits)
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), tuple(r for r, _ in kept), tuple(w for _, w in kept))


def score_quality(docs: DataFrame, model: RuleModel, threshold: float = 0.3, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = texts(docs, "doc_id").select(
        "doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Fit on the folds that may be learned from, then score every document."""
    model = fit_rules(docs, labels, "quality", fold(F.col("doc_id"), FOLDS) != 0)
    return score_quality(docs, model, threshold)


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the rules accept, all columns as they came."""
    model = fit_rules(docs, labels, "quality", fold(F.col("doc_id"), FOLDS) != 0)
    return docs.filter(model.score(F.col("text")) >= threshold)
