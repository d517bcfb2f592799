"""Rows that tie for the first place of their key, in all columns and in order alone."""

from collections import Counter

from martkit.operators import dedup


def test_tied_rows_keep_one(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PIECE", 7, raising=False)
    rows = [("a", 1, "x")] * 50 + [("a", 1, "y")] * 3 + [("a", 1, None)] * 2 + [("a", 2, "z")] + [(None, None, "n")] * 15 + [("b", 1, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = dedup.later_duplicates(df, ["k"], ["o"])
    assert out.columns == df.columns
    assert Counter(map(tuple, out.collect())) == Counter(rows) - Counter([("a", 1, None), (None, None, "n"), ("b", 1, "q")])
    # No window over the key: tied rows are counted before they are dealt.
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
