"""Raw items to dimensions, fact, rejects and a run record."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from martkit.functions.availability import STATUS_RULES
from martkit.functions.text import case_label, contains_ci
from martkit.operators.clean import (
    FILLED, TRIMMED, clean, enforce_schema, fill_nulls, quarantine, stamp, storage_problems)
from martkit.operators.dedup import dedup_keep_first
from martkit.operators.keys import build_dimension
from martkit.operators.lookup import DimRef, lookup_dimensions, measured
from martkit.operators.quality import quality_gate, quality_rejects, quality_report
from martkit.operators.stats import load_verification
from martkit.schemas import MART_RULES, MIN_QUALITY
from martkit.session import materialize
from martkit.sources.readers import default_ratings, load_readback, read_or_default
from martkit.sources.writers import MartStore, run_record, seed_ratings, write_run_metrics

# The columns of the fact in order, with their source where it differs.
FACT_COLUMNS = {
    "book_id": "upc", "title": "title", "description": "description", "price": "price",
    "in_stock": "in_stock", "available_quantity": "available_quantity", "reviews_count": "reviews_count",
    "rating_id": "rating_id", "category_id": "category_id", "product_type_id": "product_type_id",
    "image_url": "image_url", "url": "url", "scraped_at": "scraped_at",
}
PROFILED = ["title", "category", "product_type", "price", "rating"]


@dataclass
class Mart:
    """The tables of one transformation; ``deduplicated`` is what they were built from."""

    deduplicated: DataFrame
    dims: dict[str, DataFrame]
    fact: DataFrame
    rejects: DataFrame


@dataclass
class RunResult:
    """What a run leaves: the finished version and its record."""

    version: str | None
    statistics: dict = field(default_factory=dict)
    worst: DataFrame | None = None


def first_clean_rows(raw: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row per key, cleaned.

    Cleaning comes last where it leaves key and order alone, so that only the
    rows that stay are cleaned.
    """
    if {key, *order} & {*TRIMMED, *FILLED}:
        return dedup_keep_first(clean(raw), key, order)
    return clean(dedup_keep_first(raw, key, order))


def with_stock_flags(df: DataFrame) -> DataFrame:
    """In-stock flag and status from the cleaned label, and a quantity without NULL."""
    out = df.withColumns({
        "in_stock": contains_ci("availability", STATUS_RULES[0][0]),
        "availability_status": case_label("availability", STATUS_RULES, "unknown")})
    return fill_nulls(out, {"available_quantity": 0})


def project_fact(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(src).alias(name) for name, src in FACT_COLUMNS.items()])


def build_fact(deduplicated: DataFrame, categories: DimRef, product_types: DimRef, ratings: DimRef,
               minimum: float = MIN_QUALITY) -> DataFrame:
    """Rows past the quality gate, with their dimension ids."""
    accepted = with_stock_flags(quality_gate(deduplicated, minimum=minimum))
    return project_fact(lookup_dimensions(accepted, [categories, product_types, ratings]))


def category_ref(dim: DataFrame) -> DimRef:
    return DimRef(dim, "category", "category", "category_id")


def product_type_ref(dim: DataFrame) -> DimRef:
    return DimRef(dim, "product_type", "product_type", "product_type_id")


def rating_ref(dim: DataFrame) -> DimRef:
    return DimRef(dim, "rating", "rating_value", "rating_id")


def transform(raw: DataFrame, order: Sequence[str], ratings: DataFrame | None = None,
              minimum: float = MIN_QUALITY, key: str = "upc") -> Mart:
    """Clean, deduplicate, build dimensions from all remaining rows, then the fact.

    Deduplication comes before the gate: a poor first row hides a better later
    one.  The deduplicated rows are written once, because both dimensions, the
    fact and the rejects read them; the dimensions are written because their
    measured size decides how the fact is joined to them.
    """
    spark = raw.sparkSession
    kept = materialize(first_clean_rows(raw, key, order), "deduplicated")
    categories = materialize(build_dimension(kept, "category", "category_id"), "categories")
    product_types = materialize(build_dimension(kept, "product_type", "product_type_id"), "product_types")
    ratings = default_ratings(spark) if ratings is None else ratings
    fact = build_fact(kept, measured(category_ref(categories)), measured(product_type_ref(product_types)),
                      measured(rating_ref(ratings)), minimum)
    rejects = with_stock_flags(quality_rejects(kept, minimum=minimum))
    dims = {"dim_ratings": ratings, "dim_categories": categories, "dim_product_types": product_types}
    return Mart(kept, dims, fact, rejects)


def raw_counts() -> dict[str, Column]:
    """What is counted over raw rows after cleaning: rows, and NULLs of some columns."""
    return {"records": F.count("*"), **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in PROFILED}}


def profile_raw(raw: DataFrame) -> DataFrame:
    """Row count and the NULLs left after cleaning, from one narrow pass."""
    return clean(raw).agg(*[c.alias(n) for n, c in raw_counts().items()])


def first_rows_and_counts(raw: DataFrame, key: str, order: Sequence[str]) -> tuple[DataFrame, dict]:
    """The first clean row per key, written, and ``raw_counts`` over all rows: one pass over the source.

    Counters are observed beside the rows that pass, so they cost no column and no sort.  A stage that ran again
    may have counted rows again: then the counts come from a narrow pass of their own.
    """
    context, seen, group = raw.sparkSession.sparkContext, Observation(), uuid.uuid4().hex
    counted = clean(raw).observe(seen, *[c.alias(n) for n, c in raw_counts().items()])
    before = context.getLocalProperty("spark.jobGroup.id")
    context.setLocalProperty("spark.jobGroup.id", group)
    try:
        kept = materialize(dedup_keep_first(counted, key, order), "deduplicated")
    finally:
        context.setLocalProperty("spark.jobGroup.id", before)
    # Nothing is observed where Spark sees that the source is empty.
    anew = kept.isEmpty() or ran_again(context, group)
    return kept, profile_raw(raw).first().asDict() if anew else dict(seen.get)


def ran_again(context: SparkContext, group: str) -> bool:
    """Whether a stage of the group's jobs had more than one attempt, or is no longer known."""
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
    return not jobs or None in jobs or any(s is not None and s.currentAttemptId > 0 for s in stages)


def new_run_id(now: datetime) -> str:
    # Fixed value: the format of a run id.
    return f"etl_run_{now.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:8]}"


def run_mart(raw: DataFrame, store: MartStore, order: Sequence[str], minimum: float = MIN_QUALITY,
             key: str = "upc", name: str = "mart", metrics_path: str | None = None,
             drop_existing: bool = False) -> RunResult:
    """The whole job: init, extract, transform, load, verify, record.

    Counts of tables come from the finished tables, those of the source from the one pass over it
    (``first_rows_and_counts``).  Fact rows the declared table
    would refuse go to ``fact_rejects`` with their reasons, members of dimensions to
    ``dim_rejects``; facts that refer to such a member get no id.  Error texts are cut to
    200 characters, as a run record holds them.
    """
    spark, started = raw.sparkSession, datetime.now(UTC)
    record = {"etl_run_id": new_run_id(started), "spark_application_id": spark.sparkContext.applicationId}
    metrics_path = metrics_path or f"{store.root}/_runs"
    try:
        previous = store.init(drop_existing)
        # The source may change: everything that is said about it comes from this one pass.
        kept, profile = first_rows_and_counts(raw, key, order)
        extracted = profile.pop("records")
        if extracted == 0:
            return RunResult(None, {**record, "status": "no data", "extraction_records": 0})
        at = F.lit(started)
        ratings = read_or_default(spark, store.spec("dim_ratings", previous), seed_ratings(spark))

        version = store.new_version()
        refs, dim_rejects = {}, None
        for table, column, id_name in (("dim_categories", "category", "category_id"),
                                       ("dim_product_types", "product_type", "product_type_id")):
            dim = stamp(build_dimension(kept, column, id_name), "created_at", at)
            stored, refused = quarantine(dim, storage_problems(dim, MART_RULES[table]))
            stored = store.write(version, table, enforce_schema(stored, MART_RULES[table].schema))
            refs[table] = measured(DimRef(stored, column, column, id_name))
            refused = refused.select(F.lit(table).alias("table_name"), F.col(id_name).cast("bigint").alias("id"),
                                     F.col(column).alias("value"), "reject_reason")
            dim_rejects = refused if dim_rejects is None else dim_rejects.unionByName(refused)
        store.write(version, "dim_rejects", dim_rejects)
        ratings = store.write(version, "dim_ratings", ratings)
        refs["dim_ratings"] = measured(rating_ref(ratings))

        rules = MART_RULES["fact_books"]
        fact = stamp(build_fact(kept, refs["dim_categories"], refs["dim_product_types"],
                                refs["dim_ratings"], minimum), "processed_at", at)
        good, refused = quarantine(fact, storage_problems(fact, rules))
        store.write(version, "fact_books", enforce_schema(good, rules.schema))
        store.write(version, "fact_rejects", refused)
        low = store.write(version, "quality_rejects", with_stock_flags(quality_rejects(kept, minimum=minimum)))
        store.finish(version, [*MART_RULES, "dim_rejects", "fact_rejects", "quality_rejects"])

        checked = {r["table_name"]: r for r in load_verification(load_readback(
            spark, {t: store.spec(t, version) for t in MART_RULES})).collect()}
        totals, worst = quality_report(low, key)
        kept_rows, report = kept.count(), totals.first()
        low_rows = report["low_quality_count"]
        finished = datetime.now(UTC)
        seconds = (finished - started).total_seconds()
        summary = {
            **record, "total_duration_seconds": round(seconds, 2), "extraction_records": extracted,
            "transformation_books": checked["fact_books"]["records"], "quality": low_rows,
            "tables_loaded": sum(r["status"] == "loaded" for r in checked.values()), "status": "success"}
        _record(spark, metrics_path, name, True, started, finished, summary)
        details = {
            "null_profile": profile,
            "records_before": extracted, "records_after": kept_rows,
            "duplicates_removed": extracted - kept_rows,
            "not_listed": report["not_listed"],
            "tables": {t: (r["records"], r["status"]) for t, r in checked.items()}}
        return RunResult(version, {**summary, **details}, worst)
    except Exception as e:
        finished = datetime.now(UTC)
        _record(spark, metrics_path, name, False, started, finished, {
            **record, "status": "failed", "error": str(e)[:200],
            "total_duration_seconds": round((finished - started).total_seconds(), 2)})
        raise


def _record(spark: SparkSession, path: str, name: str, success: bool, started: datetime,
            finished: datetime, statistics: dict) -> None:
    row = {"etl_name": name, "success": success, "start_time": started.isoformat(),
           "end_time": finished.isoformat(), "duration_seconds": (finished - started).total_seconds(),
           "statistics": statistics}
    write_run_metrics(run_record(spark, row), path)

