"""Continuous work: sentence filters over arriving files, request queues, and streaming duplicates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_filter(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Applies a transform to the rows of every new Parquet file below source and appends them below target."""
    rows = spark.readStream.schema(schema).parquet(source)
    return transform(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def request_queue(
    spark: SparkSession, source: str, schema: str, process: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    files_per_batch: int = 1, seconds: int | None = None,
) -> StreamingQuery:
    """Requests, files_per_batch files at a time, every so many seconds (None: once, as far as there are any).

    A batch's results are written to a folder of its own, which a repeated batch overwrites: all or nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        process(rows).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def first_of_bucket(banded: DataFrame, order: str, state: str = "NoTimeout") -> DataFrame:
    """(order, band, key, first) of a stream (order, band, key): is the row the first of its bucket. The state never ends."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], group) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        seen = group.getOption
        low = seen[0] if seen is not None else None
        for frame in frames:
            for value in frame[order].sort_values():
                first = low is None
                low = value if first else low
                yield pd.DataFrame({order: [value], "band": [key[0]], "key": [key[1]], "first": [first]})
        group.update((int(low),))

    return banded.groupBy("band", "key").applyInPandasWithState(
        update, f"{order} long, band int, key long, first boolean", "low long", "append", state
    )


def claims(events: DataFrame) -> DataFrame:
    """A queue in a table: requests (event_id, ts, user_id) in the order in which workers claim them."""
    return events.select("event_id", "ts", "user_id", F.lit(None).cast("timestamp").alias("retrieved"))
