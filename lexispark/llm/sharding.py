"""Contiguous shards of nearly equal bytes.

Only narrow rows move: they are dealt by key range and sorted, and the sorted table is written once. One pass adds up
the bytes and rows of each partition; these totals (a row for each partition) give every partition its global offset,
and a running sum inside the partition gives every row its place in the global byte order. A row belongs to the shard
in whose equal share of all bytes its midpoint lies, so shards are contiguous and a shard's size differs from the
target by less than a row at either end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus 1 for the separator; null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def balanced_shards(rows: DataFrame, n_shards: int, order: list[str], size: str = "size") -> DataFrame:
    """rows with shard int and slot long (gapless from 0 in each shard), cut at equal byte targets of the order given.

    rows should be narrow: it is sorted and written as it is. size must be positive. Rows equal in all columns of
    order keep an arbitrary order among themselves, which the written table fixes; nulls in order come first; an
    empty table gives an empty result. Columns named shard and slot are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "shards")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.drop("shard", "slot")
    # The task that writes a partition numbers its rows; the file keeps the numbers, so no rerun can change them.
    ordered = scratch.keep(
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}),
        "sorted",
    )
    totals = ordered.groupBy("_part").agg(F.sum(size).alias("b"), F.count("*").alias("r")).orderBy("_part").collect()
    offsets, bytes_, count = [], 0, 0
    for t in totals:  # one row for each partition, whatever the table's size
        offsets.append((t["_part"], bytes_, count))
        bytes_, count = bytes_ + t["b"], count + t["r"]
    starts = spark.createDataFrame(offsets, "_part int, _byte0 long, _row0 long")
    here = W.partitionBy("_part").orderBy("_seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        ordered.withColumns({"_run": F.sum(size).over(here), "_nth": F.count(F.lit(1)).over(here)})
        .join(F.broadcast(starts), "_part")
        .withColumn("_start", F.col("_byte0") + F.col("_run") - F.col(size))
        .withColumn("_pos", F.col("_row0") + F.col("_nth") - 1)
        .withColumn("shard", F.least(F.floor((F.col("_start") * 2 + F.col(size)) * n_shards / F.lit(max(2 * bytes_, 1))), F.lit(n_shards - 1)).cast("int"))
        .drop("_part", "_seq", "_run", "_nth", "_start", "_byte0", "_row0")
    )
    placed = scratch.keep(placed, "placed")
    scratch.drop(ordered)
    first = placed.groupBy("shard").agg(F.min("_pos").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_pos") - F.col("_first")).drop("_pos", "_first")
