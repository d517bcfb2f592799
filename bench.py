"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.  Every query runs once
untimed, so that class loading and code generation do not count, then once timed,
with all rows and columns of its result computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "run_mart_summary", "fact_projection", "trim_fill_clean", "dedup_keep_first", "dedup_removed", "dedup_stats",
    "surrogate_keys", "surrogate_keys_large", "lookup_three_dims", "quality_report", "null_profile", "validate_items",
    "validation_stats", "availability_label", "parse_amount", "upsert_merge", "upsert_stats", "stream_upsert",
    "delay_stats", "top5_latest", "check_pk", "check_table", "fk_orphans", "quarantine_split", "quarantine_rejects",
    "page_links", "page_heading", "pages_to_items", "load_verification",
]


def main() -> None:
    from catalog import load_all
    from martkit.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    entries, times = load_all(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            entries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
