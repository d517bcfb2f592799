"""Components are found however many rounds they take."""

from martkit.llm import components


def test_no_cap_on_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "ROUNDS", 1, raising=False)
    df = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in components.components(df).collect()} == {0}
