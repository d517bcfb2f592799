import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))

from conftest_llm import prose  # noqa: E402

# Names that operators use inside; they must not clash.
EXTRA = ["n", "rid", "root", "size", "node", "score", "spans", "row", "g", "h", "line", "pos", "cut", "removed", "new"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in EXTRA]])

@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text, source) as a table like ``documents``, with more columns whose names clash."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, equal rows, a null id."""
    long = " ".join(prose(i, 500) for i in range(40))
    return [(1, None, None), (2, "", "a"), (3, prose(3), "a"), (3, prose(3), "a"), (4, prose(3), "b"), (5, long, "b"),
            (None, prose(6), "a"), (7, " \n\t ", "a"), (8, "word", "c"), (9, "ñandú 中文 🙂 é", "c")]
