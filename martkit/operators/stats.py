"""Counters and run statistics, each from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.session import local_frame


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def validation_stats(validated: DataFrame) -> DataFrame:
    """Totals over the flags that ``validate_items`` leaves in ``_validation``."""
    v = F.col("_validation")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    out = validated.agg(
        F.count("*").alias("total_processed"),
        total(v["cleaned_prices"]).alias("cleaned_prices"),
        total(v["cleaned_ints"]).alias("cleaned_ints"),
        total(v["fixed_dates"]).alias("fixed_dates"),
        F.count_if(F.size(v["missing"]) > 0).alias("validation_errors"))
    good = F.col("total_processed") - F.col("validation_errors")
    return out.withColumn("success_rate", F.coalesce(
        F.try_divide(good, F.col("total_processed")) * 100, F.lit(0.0)))


def _latest(value: str, order: str | Sequence[str]) -> Column:
    """The value of the last row; rows equal in ``order`` are told apart by the value itself."""
    columns = [order] if isinstance(order, str) else list(order)
    return F.max_by(value, F.struct(*columns, value))


def delay_stats(log: DataFrame, key: str, value: str, order: str | Sequence[str]) -> DataFrame:
    """Count, total and average over all requests; min and max of the latest value per key."""
    per_key = log.groupBy(key).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), _latest(value, order).alias("latest"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("request_count"),
        F.sum("total").alias("total_delay"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("avg_delay"),
        F.min("latest").alias("min_delay"), F.max("latest").alias("max_delay"))


def latest_values(log: DataFrame, key: str, value: str, order: str | Sequence[str]) -> DataFrame:
    """The value of the latest row per key, by a partial and a final aggregate."""
    return log.groupBy(key).agg(_latest(value, order).alias(value))


def top_k(df: DataFrame, value: str, k: int = 5, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows of highest value; each task keeps ``k`` rows, then they are merged."""
    return df.orderBy(F.col(value).desc(), *tie).limit(k)


def kind_share(log: DataFrame, predicate: Column, yes: str, no: str) -> DataFrame:
    """Counts and percentages of the rows that do and do not satisfy a predicate."""
    out = log.agg(F.count("*").alias("total"), F.count_if(predicate).alias(f"{yes}_count"))
    share = F.coalesce(F.try_divide(F.col(f"{yes}_count") * 100.0, F.col("total")), F.lit(0.0))
    return out.select(
        "total", f"{yes}_count", (F.col("total") - F.col(f"{yes}_count")).alias(f"{no}_count"),
        F.round(share, 1).alias(f"{yes}_percent"), F.round(100 - share, 1).alias(f"{no}_percent"))


def rate(count: Column, seconds: Column) -> Column:
    """Rows per second; NULL for an empty interval."""
    return F.try_divide(count, seconds)


def throughput(log: DataFrame, ts: str) -> DataFrame:
    """Rows per second between the first and the last timestamp of a log."""
    out = log.agg(F.count("*").alias("row_count"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    seconds = (F.unix_micros(F.col("_hi").cast("timestamp"))
               - F.unix_micros(F.col("_lo").cast("timestamp"))) / 1e6
    return out.select("row_count", seconds.alias("seconds"),
                      rate(F.col("row_count"), seconds).alias("rows_per_second"))


def load_verification(tables: Mapping[str, DataFrame | Exception]) -> DataFrame:
    """Per table its row count and whether it is loaded, empty or unreadable."""
    out: DataFrame | None = None
    failed: list[dict] = []
    for name, df in tables.items():
        if isinstance(df, Exception):
            failed.append({"table_name": name, "records": 0, "status": "error", "error": str(df)[:100]})
            continue
        one = df.agg(F.count("*").alias("records")).select(
            F.lit(name).alias("table_name"), "records",
            F.when(F.col("records") > 0, "loaded").otherwise("empty").alias("status"),
            F.lit(None).cast("string").alias("error"))
        out = one if out is None else out.unionByName(one)
    if failed:
        if out is None:
            raise ValueError("no table can be read: " + "; ".join(r["error"] for r in failed))
        out = out.unionByName(local_frame(out.sparkSession, failed, out.schema))
    return out
