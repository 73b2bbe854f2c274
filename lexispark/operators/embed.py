"""Sentence vectors: similarity and clusters."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, similarity, rank): the k nearest vectors of the query's label, the query itself left out."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    q = queries.select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").cast("array<double>").alias("q"))
    pairs = v.join(q, "label").where("vec_id != query_id").select("query_id", "vec_id", F.round(cosine(F.col("q"), F.col("v")), 9).alias("similarity"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_of_all(vectors: DataFrame, queries: DataFrame, k: int, block: int = 2000) -> DataFrame:
    """(query_id, vec_id, similarity, rank): the k nearest of all vectors, whatever their labels, the query itself left out.

    Blocks of queries are broadcast one by one; each Arrow batch of vectors gives the k nearest of each query, and these
    are merged. Vectors that are null, empty, zero, not finite or of another length than the query have no similarity.
    """
    ids = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    asked = queries.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).toLocalIterator()
    found = vectors.sparkSession.createDataFrame([], f"query_id {ids}, vec_id {ids}, similarity double")
    while part := list(itertools.islice(asked, block)):
        shared = vectors.sparkSession.sparkContext.broadcast(_matrices([r[0] for r in part], [r[1] for r in part]))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                have = _matrices(list(b["vec_id"]), list(b["v"]))
                for n, (qs, q) in shared.value.items():
                    if n not in have:
                        continue
                    vs, v = have[n]
                    for at in range(0, len(qs), 200):
                        sims = np.round(q[at : at + 200] @ v.T, 9)
                        sims[np.equal.outer(qs[at : at + 200], vs)] = -np.inf
                        for i, row in enumerate(sims):
                            best = np.lexsort((vs, -row))[:k]
                            best = best[row[best] > -np.inf]
                            yield pd.DataFrame({"query_id": qs[at + i], "vec_id": vs[best], "similarity": row[best]})

        found = found.unionByName(rows.mapInPandas(run, found.schema))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _matrices(ids: list, vectors: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors by length, of those that have a direction."""
    out: dict[int, tuple[list, list]] = {}
    for i, v in zip(ids, vectors, strict=True):
        x = None if v is None else np.array(v, float)
        if x is not None and len(x) and np.isfinite(x).all() and (size := np.sqrt(x @ x)) > 0:
            got = out.setdefault(len(x), ([], []))
            got[0].append(i)
            got[1].append(x / size)
    return {n: (np.array(i), np.array(x)) for n, (i, x) in out.items()}


def clusters(vectors: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """vectors with cluster, by k means from a seed."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.withColumn("_v", array_to_vector(F.col("embedding").cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("_v")


def embedded(sentences: DataFrame, load: Callable, text: str, batch_size: int = 100) -> DataFrame:
    """sentences with embedding array<float> of column text; load() gives a function from texts to vectors, once a worker."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    udf = predict_batch_udf(load, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return sentences.withColumn("embedding", udf(text))
