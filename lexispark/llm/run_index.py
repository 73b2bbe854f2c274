"""Repeated byte strings by run-length indexes of the places that can repeat.

Every window of `length` bytes names one anchor in it, the k-gram with the smallest hash (the first among equals), so
equal windows name equal anchors. A context is the bytes of all neighbouring windows of a document with one anchor.

1. Contexts are dealt by their anchor. Windows of contexts that occur twice are repeated, and need no index.
2. What is left, one copy of each context, can only share a window with a context that has the same bytes around the
   anchor, for half of what a window has besides it, on the left or on the right. Contexts that have such a partner are
   indexed with all their partners, in buckets of bounded size.
3. A bucket's index is the run-compressed Burrows-Wheeler transform of its contexts, with a suffix position and the
   length shared with the neighbour sampled at the head and the end of each run. Within a run both lengths shrink by one
   from one text position to the next, so the samples give the matching statistics of all positions in one stream: the
   longest string from there that also starts anywhere else. Windows inside such a match are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch

#: Bytes that are searched for anchors at a time (less than 2**20), and bytes of a bucket's contexts.
BATCH, BUCKET = 700_000, 1_500_000
BASE = 0x9E3779B97F4A7C15
U = np.uint64
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        out = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            p = np.full(n + 1, base, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(32)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(29)
    return x


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by minima from both ends of blocks of w."""
    n = len(x)
    pad = np.full(-n % w + w, U(2**64 - 1))
    y = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(y, axis=1).ravel()
    return np.minimum(ahead[: n - w + 1], behind[w - 1 : n])


def contexts(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Contexts of texts (BATCH bytes together): doc, first and last window start, anchor hash, keys to both sides."""
    k = length // 4
    side = -(-(length - k) // 2)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    n = len(data)
    names = ("doc", "a", "b", "h", "left", "right", "at")
    if n < length:
        return {c: np.zeros(0, U if c in ("h", "left", "right") else np.int64) for c in names}
    power, inverse = powers(n + 1)
    prefix = np.empty(n + 1, U)
    prefix[0] = 0
    np.cumsum((data.astype(U) + U(1)) * power[:n], out=prefix[1:])
    grams = mixed((prefix[k:] - prefix[:-k]) * inverse[: n - k + 1])
    keys = (grams & ~U(0xFFFFF)) | np.arange(n - k + 1, dtype=U)
    anchor = (sliding_min(keys, length - k + 1) & U(0xFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    start = np.arange(n - length + 1)
    fits = start + length <= ends[doc[start]]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1 : len(start)] != doc[: len(start) - 1]) | ~fits[:-1]]
    head = np.flatnonzero(new & fits)
    stop = np.r_[np.flatnonzero(new)[1:], len(start)]
    last = stop[np.searchsorted(stop, head, side="right")] - 1
    last = np.minimum(last, ends[doc[head]] - length)
    m = anchor[head]
    span = k + side

    def around(lo: np.ndarray, ok: np.ndarray, salt: int) -> np.ndarray:
        lo = np.where(ok, lo, 0)
        hi = np.minimum(lo + span, n)
        return np.where(ok, mixed((prefix[hi] - prefix[lo]) * inverse[lo] + U(salt)) | U(1), U(0))

    first = ends[doc[head]] - sizes[doc[head]]
    return {
        "doc": doc[head], "a": head - first, "b": last - first, "h": grams[m],
        "left": around(m - side, m - head >= side, 1), "right": around(m, m + span <= last + length, 2), "at": head,
    }


OCCURRENCE = "part long, sure boolean, row long, a long, b long, c1 long, c2 long, l long, r long"


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """Contexts of all documents (row, text); one that this batch has had before is surely repeated, and so is its first."""

    def batch(rows: list[int], offsets: list[int], texts: list[bytes]) -> pa.RecordBatch:
        c = contexts(texts, length)
        data = b"".join(texts)
        digests = [xxhash.xxh3_128_digest(data[i : i + x]) for i, x in zip(c["at"].tolist(), (c["b"] - c["a"] + length).tolist(), strict=True)]
        two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        _, inv, count = np.unique(two, axis=0, return_inverse=True, return_counts=True) if len(two) else (None, np.zeros(0, int), np.zeros(0, int))
        inv = inv.ravel()
        first = np.zeros(len(inv), bool)
        first[np.unique(inv, return_index=True)[1]] = True
        sure = count[inv] > 1
        shift = np.array(offsets, np.int64)[c["doc"]]
        row = np.array(rows, np.int64)[c["doc"]]
        part = np.where(sure & ~first, mixed(row.astype(U)), c["h"]).view(np.int64)
        # Of repeats within the batch, the first goes by its anchor, to be a partner of others.
        l, r = (np.where(sure & ~first, U(0), c[x]).view(np.int64) for x in ("left", "right"))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (part, sure, row, c["a"] + shift, c["b"] + shift, two[:, 0], two[:, 1], l, r)],
            names=["part", "sure", "row", "a", "b", "c1", "c2", "l", "r"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, offsets, texts, size = [], [], [], 0
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = text.encode()
                for at in range(0, max(1, len(data) - length + 1), BATCH):
                    piece = data[at : at + BATCH + length - 1]
                    if len(piece) < length:
                        continue
                    if size + len(piece) > BATCH + length and texts:
                        yield batch(rows, offsets, texts)
                        rows, offsets, texts, size = [], [], [], 0
                    rows.append(row)
                    offsets.append(at)
                    texts.append(piece)
                    size += len(piece)
        if texts:
            yield batch(rows, offsets, texts)

    return docs.select("row", "text").mapInArrow(run, OCCURRENCE)


FOUND = "mark boolean, row long, a long, b long, key long, multi boolean"


def sorted_out(occ: DataFrame, n: int) -> DataFrame:
    """Marks of contexts that occur twice, and contexts with partners under each key they share with another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if t is None or not len(t):
            return
        col = {c: t.column(c).to_numpy(zero_copy_only=False) for c in t.column_names}
        order = np.lexsort((col["a"], col["row"], col["c2"], col["c1"]))
        col = {c: x[order] for c, x in col.items()}
        new = np.r_[True, (col["c1"][1:] != col["c1"][:-1]) | (col["c2"][1:] != col["c2"][:-1])]
        group = np.cumsum(new) - 1
        twice = (np.bincount(group) > 1)[group] | np.isin(group, np.unique(group[col["sure"]]))
        yield out(True, col["row"][twice], col["a"][twice], col["b"][twice], None, None)
        # One copy of each context that is here by its anchor; of those not surely repeated, the only one.
        by_anchor = (col["l"] != 0) | (col["r"] != 0)
        at = np.flatnonzero(by_anchor)
        at = at[np.r_[True, group[at][1:] != group[at][:-1]]] if len(at) else at
        for side in ("l", "r"):
            key = col[side][at]
            some = at[key != 0]
            _, inv, count = np.unique(col[side][some], return_inverse=True, return_counts=True)
            some = some[count[inv] > 1]
            yield out(False, col["row"][some], col["a"][some], col["b"][some], col[side][some], twice[some])

    def out(mark: bool, row: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray | None, multi: np.ndarray | None) -> pa.RecordBatch:
        n = len(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, mark)), pa.array(row), pa.array(a), pa.array(b), pa.array(np.zeros(n, np.int64) if key is None else key), pa.array(np.zeros(n, bool) if multi is None else multi)],
            names=["mark", "row", "a", "b", "key", "multi"],
        )

    return occ.repartition(n, "part").mapInArrow(run, FOUND)


def suffix_array(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of bytes and their first eight bytes as numbers; doubling sorts only what is still tied."""
    n = len(t)
    padded = np.concatenate([t, np.zeros(8, np.uint8)]).astype(U)
    packed = np.zeros(n, U)
    for i in range(8):
        packed = (packed << U(8)) | padded[i : i + n]
    sa = np.argsort(packed, kind="stable")
    rank = np.empty(n, np.int64)

    def ranks(at: np.ndarray, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        new = np.r_[True, keys[1:] != keys[:-1]]
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        return ~(new & np.r_[new[1:], True])

    tied = ranks(sa, packed[sa], np.arange(n))
    at, slots, h = sa[tied], np.flatnonzero(tied), 8
    while len(at):
        nxt = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        keys = rank[at] * (n + 1) + nxt
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        sa[slots] = at
        tied = ranks(at, keys, slots)
        at, slots, h = at[tied], slots[tied], h * 2
    return sa, packed


def shared_lengths(packed: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common start of the suffixes at i and j, eight bytes at a time."""
    n = len(packed)
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        p, q = i[live] + out[live], j[live] + out[live]
        ok = (p < n) & (q < n)
        x = np.where(ok, packed[np.minimum(p, n - 1)] ^ packed[np.minimum(q, n - 1)], U(2**63))
        same = x == 0
        stop = live[~same]
        lead = np.zeros(len(stop), np.int64)
        y = x[~same].copy()
        for step in (32, 16, 8):
            zero = y >> U(64 - step) == 0
            lead[zero] += step
            y[zero] <<= U(step)
        out[stop] += lead // 8
        live = live[same]
        out[live] += 8
    return np.minimum(out, n - np.maximum(i, j))


class RunIndex:
    """Run-compressed transform of a text with samples at both ends of each run."""

    def __init__(self, t: np.ndarray) -> None:
        sa, packed = suffix_array(t)
        bwt = t[sa - 1].astype(np.int16)
        bwt[sa == 0] = -1  # nothing stands before the text: a run of its own
        self.n = len(t)
        head = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        end = np.r_[head[1:] - 1, self.n - 1]
        self.symbols, self.lengths = bwt[head], end - head + 1
        self.heads, self.ends = sa[head], sa[end]
        self.head_shared = np.zeros(len(head), np.int64)
        self.head_shared[1:] = shared_lengths(packed, sa[head[1:]], sa[head[1:] - 1])
        self.end_shared = np.zeros(len(head), np.int64)
        self.end_shared[:-1] = shared_lengths(packed, sa[end[:-1]], sa[end[:-1] + 1])

    def matching_statistics(self) -> np.ndarray:
        """For each text position, the length of the longest string from there that also starts elsewhere."""
        best = np.zeros(self.n, np.int64)
        for places, shared in ((self.heads, self.head_shared), (self.ends, self.end_shared)):
            order = np.argsort(places)
            at, value = places[order], shared[order]  # position 0 is among them
            i = np.arange(self.n)
            k = np.searchsorted(at, i, side="right") - 1
            best = np.maximum(best, value[k] - (i - at[k]))
        return best


def long_matches(pieces: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each piece, runs (first, last) of starts of strings of this length that occur elsewhere in the pieces."""
    # A byte that UTF-8 never has ends each piece, so no string of this length runs over an end elsewhere.
    sizes = np.array([len(p) for p in pieces], np.int64)
    t = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8)
    first = np.cumsum(sizes + 1) - sizes - 1
    stats = RunIndex(t).matching_statistics()
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    at = np.arange(len(t))
    good = (stats >= length) & (at + length <= (first + sizes)[owner])
    edge = np.flatnonzero(np.diff(np.r_[0, good.astype(np.int8), 0]))
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for lo, hi in edge.reshape(-1, 2):
        for k in range(owner[lo], owner[hi - 1] + 1):
            a, b = max(lo, first[k]), min(hi - 1, first[k] + sizes[k])
            out[k].append((int(a - first[k]), int(b - first[k])))
    return out


def indexed(cand: DataFrame, docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """Marks (row, a, b) of the candidates (row, a, b, key, multi), indexed with those that share a key."""
    total = cand.agg(F.sum(F.col("b") - F.col("a") + length + 1)).first()[0]
    buckets = max(1, -(-(total or 0) // BUCKET))
    per = cand.groupBy("row").agg(F.collect_set(F.struct("a", "b", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "multi")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text, found in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist(), strict=True):
                data = text.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["bucket"] for x in found], pa.int64()), pa.array([row] * len(found), pa.int64()), pa.array([x["a"] for x in found], pa.int64()),
                     pa.array([x["multi"] for x in found], pa.bool_()), pa.array([data[x["a"] : x["b"] + length] for x in found], pa.binary())],
                    names=["bucket", "row", "a", "multi", "piece"],
                )

    def search(_: tuple, t: pa.Table) -> pa.Table:
        rows, starts, multi, pieces = (t.column(c).to_pylist() for c in ("row", "a", "multi", "piece"))
        got = [
            (r, s + lo, s + hi)
            for r, s, m, found in zip(rows, starts, multi, long_matches(pieces, length), strict=True) if not m
            for lo, hi in found
        ]
        return pa.table({c: pa.array([x[i] for x in got], pa.int64()) for i, c in enumerate(("row", "a", "b"))})

    cut_pieces = picked(docs, per, scratch).mapInArrow(cut, "bucket long, row long, a long, multi boolean, piece binary")
    return cut_pieces.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(search, "row long, a long, b long")


def picked(docs: DataFrame, per: DataFrame, scratch: Scratch) -> DataFrame:
    """docs joined with per on row; where few rows have a partner, only their texts are moved."""
    per = scratch.keep(per, "per")
    if per.count() <= BROADCAST_ROWS:
        docs = docs.join(F.broadcast(per.select("row")), "row", "left_semi")
    return docs.join(per, "row")


def repeated_bytes(docs: DataFrame, length: int = 400) -> DataFrame:
    """(row, doc_id, n_bytes, removed, kept_sha256) for every row of docs (doc_id, text).

    removed holds the maximal runs (array of start, end; bytes, end exclusive) of bytes covered by a string of `length`
    bytes that starts anywhere else too, in any document or the same one; overlaps count, and strings never cross
    documents. kept_sha256 is of the other bytes. A null text is empty; rows repeated with `length` bytes or more remove
    each other whole; other columns are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "runs")
    # Four jobs read the texts by row, and Spark may deal the same files otherwise in each: rows are numbered once.
    docs = scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")), "docs")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.keep(sorted_out(occurrences(docs, length), n), "found")
    marks = found.where("mark").select("row", "a", "b")
    cand = found.where("not mark").select("row", "a", "b", "key", "multi")
    marks = marks.unionByName(scratch.keep(indexed(cand, docs, length, scratch), "indexed"))
    per = marks.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, digests = [], []
            for text, found in zip(b.column("text").to_pylist(), b.column("found").to_pylist(), strict=True):
                data, runs = text.encode(), []
                for x in found:
                    lo, hi = x["a"], x["b"] + length
                    if runs and lo <= runs[-1]["end"]:
                        runs[-1]["end"] = max(hi, runs[-1]["end"])
                    else:
                        runs.append({"start": lo, "end": hi})
                spans.append(runs)
                kept = hashlib.sha256()
                at = 0
                for r in [*runs, {"start": len(data), "end": 0}]:
                    kept.update(data[at : r["start"]])
                    at = r["end"]
                digests.append(kept.hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(spans, kind), pa.array(digests, pa.string())], names=["row", "removed", "kept"])

    cut_rows = picked(docs.select("row", "text"), per, scratch).mapInArrow(cut, "row long, removed array<struct<start: long, end: long>>, kept string")
    whole = docs.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return whole.join(cut_rows, "row", "left").select(
        "row", "doc_id", "n_bytes", F.coalesce("removed", F.array().cast("array<struct<start: long, end: long>>")).alias("removed"), F.coalesce("kept", "sha").alias("kept_sha256")
    )
