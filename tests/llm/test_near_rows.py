"""Rows that stay after near copies are dropped: one of each group, for repeated rows and null ids too."""

from pyspark.sql import functions as F

from conftest_llm import prose
from martkit.llm import jaccard


def test_one_row_of_each_group(spark, frame):
    rows = [(5, prose(1, 80)), (5, prose(1, 80)), (9, prose(1, 80)), (None, prose(1, 80)), (None, prose(1, 80)),
            (None, prose(2, 80)), (None, prose(2, 80)), (6, prose(3, 80)), (6, prose(3, 80)), (6, prose(4, 80)),
            (7, ""), (7, ""), (8, None), (None, None), (None, ""), (11, prose(5, 3)), (10, prose(5, 3))]
    docs = frame(rows).withColumn("lang", F.monotonically_increasing_id().cast("string"))
    out = jaccard.drop_near_copies(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(5, prose(1, 80)), (None, prose(2, 80)), (6, prose(3, 80)), (6, prose(4, 80)), (7, ""), (8, None),
            (None, None), (None, ""), (10, prose(5, 3))]
    assert got == sorted(want, key=str)
