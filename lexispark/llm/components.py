"""Connected components of a link table, by alternating large and small stars. Nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id in links (a long, b long); component is the smallest id reachable.

    Each round moves every id to the smallest id among its neighbours; the table of links never grows. Self-links and
    repeated links are harmless; no links give no rows.
    """
    edges = scratch.keep(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = scratch.keep(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
        small = scratch.keep(small.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small")
        scratch.drop(edges, large)
        edges = small
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = edges.select(F.col("b").alias("id")).distinct().join(edges.select(F.col("a").alias("id")), "id", "left_anti")
    return scratch.keep(found.unionByName(roots.withColumn("component", F.col("id"))), "components")
