"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """id, comp (the smallest id reachable) of every id in ``links`` (u, v).

    Each pass hangs larger neighbours, then smaller ones, on the smallest id around;
    the number of passes grows with the logarithm of the longest path. Minima are
    pre-aggregated, and every pass is written to the shared folder.
    """
    edges = written(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", "m")).distinct())
        edges = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    # stars now: every id points at the smallest of its component
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
