"""Near-duplicate sentences by the words that carry content.

A sentence's fingerprint is its set of content lemmas. Signatures of 128 minima are cut to five bands of 25 rows; two
sentences collide if a band is equal. In the order given, a sentence is a duplicate if it collides with one that was
kept before it: rounds decide all sentences whose earlier neighbours are decided.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of speech that carry no content.
UPOS = ["ADP", "CCONJ", "DET", "PRON", "PUNCT"]
XPOS = ["PTKA", "PTKZU"]
PERMUTATIONS, BANDS, ROWS = 128, 5, 25
PRIME = (1 << 31) - 1
KEYS = [f"key{i}" for i in range(BANDS)]
#: Words whose permutations are held at a time.
STEP = 16384


def fingerprints(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, lemmas): sorted distinct content lemmas; a token without tags counts, a sentence without any has none."""
    keep = F.lit(True)
    if "upos" in tokens.columns:
        keep = keep & ~F.coalesce(F.col("upos"), F.lit("_")).isin(*UPOS)
    if "xpos" in tokens.columns:
        keep = keep & ~F.coalesce(F.col("xpos"), F.lit("_")).isin(*XPOS)
    lemma = F.coalesce(F.nullif("lemma", F.lit("")), "form") if "lemma" in tokens.columns else F.col("form")
    return tokens.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(keep, lemma))).alias("lemmas"))


def _permuted(hashes: np.ndarray) -> np.ndarray:
    """All permutations of hashes below 2^28; the remainder by folding, as PRIME is a power of two less one."""
    a, b = (np.array([m * (i + d) % PRIME for i in range(PERMUTATIONS)], np.uint64) for m, d in ((48271, 1), (69621, 7)))
    x = hashes[:, None] * a + b
    x = ((x & np.uint64(PRIME)) + (x >> np.uint64(31))).astype(np.uint32)
    return np.minimum(x, x - np.uint32(PRIME))


def _minima(flat: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
    """out[i] becomes the signature of the next sizes[i] hashes of flat, longest first; steps of bounded size."""
    begins, at, full = np.cumsum(sizes) - sizes, 0, np.count_nonzero(sizes)
    while at < full:
        size, begin = int(sizes[at]), int(begins[at])
        if size > STEP:
            for k in range(0, size, STEP):
                np.minimum(out[at], _permuted(flat[begin + k : begin + min(size, k + STEP)]).min(axis=0), out=out[at])
            at += 1
            continue
        end = min(full, at + STEP // size)
        known, index = np.unique(flat[begin : int(begins[end - 1] + sizes[end - 1])], return_inverse=True)
        table, starts, left = _permuted(known), begins[at:end] - begin, sizes[at:end]
        for k in range(size):
            n = int(np.searchsorted(-left, -k))
            np.minimum(out[at : at + n], table[index[starts[:n] + k]], out=out[at : at + n])
        at = end


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signed(batches):
    for batch in batches:
        lists = batch.column(batch.schema.names.index("lemmas"))
        words = lists.flatten().dictionary_encode()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words.dictionary.to_pylist()], np.uint64)
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        moved = np.repeat((np.cumsum(sizes) - sizes)[order] - (np.cumsum(ordered) - ordered), ordered) + np.arange(ordered.sum())
        out = np.full((len(sizes), PERMUTATIONS), PRIME, np.uint32)
        _minima(hashes[words.indices.to_numpy(zero_copy_only=False)[moved]], ordered, out)
        rows, keys = np.ascontiguousarray(out.T), []
        for band in range(BANDS):
            h = np.full(len(sizes), band + 1, np.uint64)
            for i in range(band * ROWS, (band + 1) * ROWS):
                h = (h ^ rows[i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            back = np.empty_like(h)
            back[order] = _mixed(h)
            keys.append(pa.array(back.view(np.int64)))
        names = [n for n in batch.schema.names if n != "lemmas"]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(n)) for n in names] + keys, [*names, *KEYS])


def signed(prints: DataFrame, *keys: str) -> DataFrame:
    """(keys, key0 to key4): hashes of the five bands of each signature; all empty fingerprints are equal.

    A word that stands twice in lemmas changes nothing. No keys are equal but those of equal bands, band numbers included.
    """
    rows = prints.select(*keys, F.array_compact("lemmas").alias("lemmas"))
    schema = T.StructType([*rows.select(*keys).schema.fields, *[T.StructField(k, T.LongType()) for k in KEYS]])
    return rows.mapInArrow(_signed, schema)


def bands(prints: DataFrame, *keys: str) -> DataFrame:
    """(keys, band, key): the hash of each band."""
    parts = F.array(*[F.struct(F.lit(i).alias("band"), F.col(k).alias("key")) for i, k in enumerate(KEYS)])
    return signed(prints, *keys).select(*keys, F.explode(parts).alias("x")).select(*keys, "x.band", "x.key")


def kept_first(rows: DataFrame, order: str) -> DataFrame:
    """(order): all that is kept of rows (order, key0 to key4).

    Of rows with equal keys only the first can be kept: what drops it drops the others, and if it is kept it drops them.
    Of the firsts only those that share a bucket go through rounds.
    """
    firsts = rows.groupBy(*KEYS).agg(F.min(order).alias(order)).persist(StorageLevel.DISK_ONLY)
    parts = firsts.select(order, F.posexplode(F.array(*KEYS)).alias("band", "key"))
    shared = parts.withColumn("n", F.count("*").over(W.partitionBy("key"))).where("n > 1").drop("n")
    gone = greedy_keep(shared, order).where("NOT kept").select(order)
    return firsts.select(order).join(gone, order, "left_anti")


def greedy_keep(banded: DataFrame, order: str) -> DataFrame:
    """(order, kept) for every value of order in banded (order, band, key).

    Each round keeps what is the first undecided one in all of its buckets, then drops the others of these buckets.
    Buckets are never expanded into pairs. State is cut by checkpoint().
    """
    left = banded.select(order, "band", "key").checkpoint()
    decided: DataFrame | None = None
    while True:
        first = left.groupBy("band", "key").agg(F.min(order).alias("first"))
        marked = left.join(first, ["band", "key"]).groupBy(order).agg(F.min((F.col("first") == F.col(order)).cast("int")).alias("kept"))
        kept = marked.where("kept = 1").select(order)
        gone = left.join(left.join(kept, order).select("band", "key").distinct(), ["band", "key"]).select(order).distinct().join(kept, order, "left_anti")
        step = kept.withColumn("kept", F.lit(True)).unionByName(gone.withColumn("kept", F.lit(False))).checkpoint()
        decided = step if decided is None else decided.unionByName(step)
        left = left.join(step, order, "left_anti").checkpoint()
        if left.isEmpty():
            return decided


def deduplicated(sentences: DataFrame, tokens: DataFrame, order: str) -> DataFrame:
    """sentences with is_duplicate, by their tokens (order, form, ...)."""
    verdict = greedy_keep(bands(fingerprints(tokens, order), order), order)
    return sentences.join(verdict, order, "left").withColumn("is_duplicate", ~F.coalesce("kept", F.lit(True))).drop("kept")
