"""Near copies: texts without one are not shuffled, whatever the size of the tables they are looked up in."""

import pytest

from conftest_llm import prose
from martkit.llm import jaccard
from test_pairs import near


def most_shuffled(plan):
    """Rows of the largest shuffle of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    below = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [
        plan.children().apply(i) for i in range(plan.children().size())]
    metric = plan.metrics().get("shuffleRecordsWritten")
    return max([metric.get().value() if metric.isDefined() else 0, *map(most_shuffled, below)])


@pytest.fixture
def no_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


def test_texts_without_copies_are_not_shuffled(spark, frame, monkeypatch, no_broadcasts):
    made, stored = {}, jaccard.stored

    def kept(df, name, *rows):
        if name == "jaccard-sets":
            df.collect()
            made[name] = most_shuffled(df._jdf.queryExecution().executedPlan())
        return stored(df, name, *rows)
    monkeypatch.setattr(jaccard, "stored", kept)
    rows = [(i, prose(i, 80)) for i in range(300)] + [(1000 + i, near(prose(1, 80), i, 1)) for i in range(9)]
    rows += [(None, prose(2, 80)), (None, prose(700, 80)), (3, prose(3, 80)), (2000, None), (2001, "")]
    out = jaccard.drop_near_copies(frame(rows))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    assert got == sorted([(False, i) for i in range(300)] + [(True, 0), (False, 2000), (False, 2001)])
    assert made["jaccard-sets"] < 30 and most_shuffled(out._jdf.queryExecution().executedPlan()) < 30
