"""Chat requests and replies of a language-model service."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payloads(turns: DataFrame, model: str) -> DataFrame:
    """(conv_id, body): the JSON request with all messages of a conversation in the order of their turns."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    rows = turns.groupBy("conv_id").agg(ordered.alias("m"))
    return rows.select("conv_id", F.to_json(F.struct(F.lit(model).alias("model"), messages.alias("messages"))).alias("body"))


def completed(requests: DataFrame, load: Callable) -> DataFrame:
    """requests (correlation_id, body) with reply and error; load() gives a function from a body to a reply, once a worker."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = load()
        for frame in frames:
            replies, errors = [], []
            for body in frame.body:
                try:
                    replies.append(call(body))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a failed request is answered with its error
                    replies.append(None)
                    errors.append(str(e))
            yield frame[["correlation_id"]].assign(reply=replies, error=errors)

    return requests.select("correlation_id", "body").mapInPandas(run, "correlation_id string, reply string, error string")


def meter(replies: DataFrame) -> DataFrame:
    """How many replies, and how many of them failed."""
    return replies.agg(F.count("*").alias("requests"), F.count("error").alias("errors"))
