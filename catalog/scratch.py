"""A scratch folder for sessions that were started without one, as in tests on one machine."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession

from martkit.session import scratch_is_set, use_scratch


def with_scratch(run):
    """The query with a scratch folder; only a local session gets one, once."""
    @functools.wraps(run)
    def ready(spark: SparkSession, sf_dir: str):
        if not scratch_is_set(spark) and spark.conf.get("spark.master", "").startswith("local"):
            use_scratch(spark, tempfile.mkdtemp(prefix="martkit-"))
        return run(spark, sf_dir)
    return ready
