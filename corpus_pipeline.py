"""From raw documents to packed token ids: quality, near copies, benchmark text, source weights, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept;
all but the last return the columns of ``documents``.  ``run`` writes each stage's rows
to the shared scratch folder and reads them again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martkit.llm import decontaminate, jaccard, mixture, quality_rules, token_shards
from martkit.llm.base import TEXT_ROWS, stored, table


#: Bytes of words that a task of the last stage remembers: by then the executors' JVMs have grown to their limit.
TOKEN_MEMORY = 40 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return quality_rules.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard.drop_near_copies(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated spans are cut out; documents that are mostly benchmark text go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixture.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids with their index; the rows are read back from the files."""
    return token_shards.write_and_digest(docs, memory=TOKEN_MEMORY)


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark_text", benchmark_text),
          ("source_weights", source_weights), ("token_ids", token_ids)]

#: No SQL can state a trained classifier, so the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", TEXT_ROWS)
    return docs
