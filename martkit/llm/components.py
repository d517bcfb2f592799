"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martkit.llm.base import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``member`` and ``root`` (its component's smallest member) for every end of a link.

    Every round groups links by one end, replaces them by links to the smallest neighbour and
    is written to the shared folder; a vertex with very many links is a partial aggregate and
    a join that adaptive execution can split.  Links never meet in one place.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    before, mark = None, _mark(edges)
    # Every round but the last brings links closer to stars, so this ends, after few rounds as a rule.
    while mark != before:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct(), "components")
        before, mark = mark, _mark(edges)
    stars = edges.select(F.col("u").alias("member"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("member"), F.col("v").alias("root")).distinct())
