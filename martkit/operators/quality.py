"""Quality gate, null profile and the report on rejected rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.text import percent_text, preview
from martkit.schemas import MIN_QUALITY

# Fixed value: what a report line shows where there is no title.
NO_TITLE = "Без названия"


def quality_gate(df: DataFrame, score: str = "data_quality_score", minimum: float = MIN_QUALITY) -> DataFrame:
    return df.where(F.col(score) >= minimum)


def quality_rejects(df: DataFrame, score: str = "data_quality_score", minimum: float = MIN_QUALITY,
                    null_score: str = "drop") -> DataFrame:
    """Rows below the minimum; rows without a score only with ``null_score="reject"``."""
    below = F.col(score) < minimum
    if null_score == "reject":
        below = below | F.col(score).isNull()
    elif null_score != "drop":
        raise ValueError("null_score is 'drop' or 'reject'")
    return df.where(below)


def split_by_quality(df: DataFrame, score: str = "data_quality_score", minimum: float = MIN_QUALITY,
                     null_score: str = "drop") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows.  Pass a materialised input: both parts read it."""
    return quality_gate(df, score, minimum), quality_rejects(df, score, minimum, null_score)


def null_profile(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """One row with ``null_<name>`` per column, from a single aggregate."""
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(f"null_{n}") for n in names])


def reject_summary(rejects: DataFrame, score: str = "data_quality_score") -> DataFrame:
    """How many rows were rejected and their score range.

    The ids of the rejected rows stay a table (``reject_ids``): one text of all
    of them would have to pass through one task.
    """
    return rejects.agg(
        F.count("*").alias("low_quality_count"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"))


def reject_ids(rejects: DataFrame, key: str) -> DataFrame:
    return rejects.select(key)


def worst_k(rejects: DataFrame, key: str, title: str = "title", score: str = "data_quality_score",
            k: int = 10, default_title: str = NO_TITLE) -> DataFrame:
    """The ``k`` rows of lowest score as report lines; ties go by key."""
    rows = rejects.select(key, title, score).orderBy(
        F.col(score).asc(), F.col(key).asc_nulls_first(), F.col(title).asc_nulls_first()).limit(k)
    return rows.select(
        key, preview(title, 50, default_title).alias("title_preview"),
        F.col(score), percent_text(score).alias("score_text"))


def quality_report(rejects: DataFrame, key: str, score: str = "data_quality_score",
                   k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Totals of the rejected rows with how many the list leaves out, and the list of the worst."""
    totals = reject_summary(rejects, score).withColumn("not_listed", remainder(F.col("low_quality_count"), k))
    return totals, worst_k(rejects, key, score=score, k=k)


def remainder(count: Column, k: int = 10) -> Column:
    """How many rows a list of ``k`` leaves out."""
    return F.greatest(count - k, F.lit(0))


def completeness_rate(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Percentage of non-NULL values over the given columns, with its grade."""
    names = list(names)
    filled = sum((F.count(n) for n in names), F.lit(0))
    rate = F.coalesce(F.try_divide(filled * 100.0, F.count("*") * len(names)), F.lit(0.0))
    return df.agg(F.round(rate, 2).alias("completeness_rate")).withColumn(
        "grade", completeness_grade("completeness_rate"))


def completeness_grade(rate: Column | str) -> Column:
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.when(rate >= 90, "ok").when(rate >= 70, "warning").otherwise("critical")
