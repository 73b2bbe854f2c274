"""Exact lists of URL prefixes as cascades of Bloom filters.

The keys a corpus can ask for are known: every suffix of a host, with every leading part of a path that is as long as
some rule's. Over this universe the first filter encodes the listed keys, the second those unlisted keys that the
first one lets through, the third the listed keys that the second lets through, and so on, until a level lets nothing
wrong through. The number of levels that a key passes then says exactly whether it is listed: no rule table is joined
to the pages. The first rate follows the ratio of both sides, so all levels together have a few bits for each listed
key, times the logarithm of that ratio, and what is broadcast is bounded by the list, not by the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

#: A cascade of more bytes is refused: it would be broadcast to every executor.
MAX_BYTES = 512 << 20
MAX_LEVELS = 64


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys that a rule for this URL can have, longest first (among equals the longer host)."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes)
    fits = F.filter(F.array(*map(F.lit, lengths)), lambda n: F.length(path) >= n)
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(fits, lambda n: F.struct(
        (-(F.length(h) + n)).alias("n"), (-F.length(h)).alias("h"), F.concat(h, F.substr(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.array_sort(pairs), lambda x: x["key"])


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key, F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")]


class Bloom:
    def __init__(self, n: int, rate: float, level: int) -> None:
        self.level = np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
        self.m = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
        self.k = max(1, round(math.log(1 / rate) / math.log(2)))
        self.bits = np.zeros(self.m // 8 + 1, np.uint8)

    def places(self, h1: np.ndarray, h2: np.ndarray) -> Iterator[np.ndarray]:
        a = (h1 ^ self.level) * np.uint64(0xFF51AFD7ED558CCD)
        a ^= a >> np.uint64(33)
        b = (h2 ^ self.level) * np.uint64(0xC4CEB9FE1A85EC53) | np.uint64(1)
        b ^= b >> np.uint64(29)
        for i in range(self.k):
            x = a + np.uint64(i) * b
            yield (x ^ (x >> np.uint64(31))) % np.uint64(self.m)

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for at in self.places(h1, h2):
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in self.places(h1, h2):
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def listed(levels: list[Bloom], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The first level that a key fails decides: keys that pass an odd number of levels are listed."""
    passed, live = np.zeros(len(h1), np.int64), np.ones(len(h1), bool)
    for f in levels:
        live = live & f.has(h1, h2)
        passed += live
    return passed % 2 == 1


def filled(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """The filter of all (h1, h2) in keys: each task fills bits, the driver joins a bounded number of them."""
    empty = Bloom(n, rate, level)
    if len(empty.bits) > MAX_BYTES:
        raise ValueError(f"a filter of {n} keys is too large to broadcast: split the list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Bloom(n, rate, level)
        for b in batches:
            f.add(*(b.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")))
        yield pa.RecordBatch.from_arrays([pa.array([f.bits.tobytes()])], names=["bits"])

    for row in keys.coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        empty.bits |= np.frombuffer(row["bits"], np.uint8)
    return empty


def cascade(universe: DataFrame, keys: DataFrame) -> list[Bloom]:
    """Levels for distinct keys (h1, h2) among a distinct universe (h1, h2): exact for every key of the universe."""
    scratch = Scratch(universe.sparkSession, "cascade")
    inside = scratch.keep(keys.select("h1", "h2").distinct())
    outside = universe.join(inside, ["h1", "h2"], "left_anti")
    n_in, n_out = inside.count(), universe.count()
    levels: list[Bloom] = []
    rate = min(0.5, math.sqrt(0.5) * max(n_in, 1) / max(n_out, 1))
    encoded, others, n = inside, outside, n_in
    while n:
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys of the universe have equal hashes")
        f = filled(encoded, n, rate if not levels else 0.5, len(levels) + 1)
        levels.append(f)

        def through(batches: Iterator[pa.RecordBatch], f: Bloom = f) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(f.has(*(b.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")))))

        encoded, others = scratch.keep(others.select("h1", "h2").mapInArrow(through, "h1 long, h2 long")), encoded
        n = encoded.count()
    if sum(len(f.bits) for f in levels) > MAX_BYTES:
        raise ValueError("the cascade is too large to broadcast: split the list")
    return levels


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict (columns of these names are replaced).

    rules (key, verdict): key is a host and, from its first slash on, the start of a path; verdict is allow or block
    (block wins where a key has both). A rule fits its host and all subdomains if the URL's path starts with the
    rule's; the longest key that fits wins, among equals the one with the longer host. Without one the verdict is
    default. A null URL or one without :// has an empty host and path and no rule; repeated rows are judged alike;
    with no pages or no rules nothing is listed. Rules with null are left out.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "urls")
    rules = rules.dropna(subset=["key", "verdict"])
    # As many as the rules' paths have lengths.
    lengths = sorted({r[0] for r in rules.select((F.length("key") - F.instr("key", "/") + 1).alias("n")).where(F.instr("key", "/") > 0).distinct().collect()})
    if rules.where(F.instr("key", "/") == 0).limit(1).count():
        lengths = sorted({0, *lengths})
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if not lengths:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidates(F.col("host"), F.col("path"), lengths)
    asked = pages.select("host", F.substr("path", F.lit(1), F.lit(lengths[-1])).alias("path")).distinct().select(F.explode(keys).alias("key")).distinct()
    universe = scratch.keep(asked.select(*hashes(F.col("key"))))
    levels = {v: spark.sparkContext.broadcast(cascade(universe, rules.where(F.col("verdict") == v).select(*hashes(F.col("key"))))) for v in ("block", "allow")}

    def which(h1: pa.Array, h2: pa.Array) -> pa.Array:
        """Per row: place (from 1) of the first listed key, negative for block; 0 for none."""
        sizes = np.diff(h1.offsets.to_numpy())
        a, b = (x.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for x in (h1, h2))
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        out = np.zeros(len(sizes), np.int32)
        block, allow = listed(levels["block"].value, a, b), listed(levels["allow"].value, a, b)
        hit = np.flatnonzero(block | allow)[::-1]  # the first one is written last
        out[row[hit]] = np.where(block[hit], -place[hit], place[hit])
        return pa.array(out)

    found = F.arrow_udf(which, T.IntegerType())
    judged = pages.withColumn("_keys", keys).withColumn(
        "_at", found(F.transform("_keys", lambda k: F.xxhash64(k, F.lit(1))), F.transform("_keys", lambda k: F.xxhash64(F.lit(2), k)))
    )
    return judged.withColumns({
        "rule": F.when(F.col("_at") != 0, F.element_at("_keys", F.abs("_at"))),
        "verdict": F.when(F.col("_at") < 0, "block").when(F.col("_at") > 0, "allow").otherwise(default),
    }).drop("_keys", "_at")
