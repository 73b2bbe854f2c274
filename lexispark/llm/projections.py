"""Linked vectors by counting collisions of random one-dimensional projections.

Vectors of unit length are projected on m random directions. Around each query a window is laid on every projection;
for a pair at the cosine threshold the difference of its projections is normal with a known deviation, so the number of
windows that it shares is binomial. The count asked for is calibrated on that: a linked pair fails with at most
probability MISS, while most other pairs share few windows. Pairs that pass are verified in double precision.

Which pairs are counted is decided by sorted projections, too. The first few ones, the more the larger the largest label
is, cut a label's vectors into cells, and the next one orders a cell's vectors into blocks. A block meets those that come
within a wide window (CUT deviations) on each of these projections, and only vectors inside that window are sent there.
A wide window holds about two fifths of all vectors of a label, three of them a fifteenth: a share that is fixed by the
threshold, for vectors without structure, so that pairs that are counted still grow with the square of a label's size.
The projections' losses together: a pair at the threshold exactly is lost with probability below one in a thousand.

A task gives counts of links and, of the links, only those that join two components, so a group of many close vectors
gives few rows. Equal vectors are one class with a multiplicity from the start; classes and all joins go by numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch
from .components import components

PROJECTIONS = 16
#: Half windows, in deviations of the difference at the threshold: of those that count, and of those that cut.
WINDOW, CUT = 2.5, 4.0
MISS = 1e-6
#: Vectors of a block, and the most projections that cut cells.
BLOCK, CUTS = 2048, 4
#: Queries, neighbours in order, that a task counts at a time.
STEP = 64


def count_needed(m: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that a pair at the threshold fails to reach with at most probability miss."""
    p = erf(window / sqrt(2))
    total, t = 0.0, 0
    while t < m:
        total += comb(m, t) * p**t * (1 - p) ** (m - t)
        if total > miss:
            break
        t += 1
    return max(1, t)


def directions(d: int, m: int) -> np.ndarray:
    return np.random.default_rng(9).standard_normal((d, m))


def projected(rows: DataFrame, m: int) -> DataFrame:
    """rows (row, v) with d, the length of v, k1 and k2, a digest of 128 bits, and p, m projections at unit length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for b in batches:
            p, keys, sizes = [], [], []
            for v in b.column("v").to_numpy(zero_copy_only=False):
                v = np.asarray(v, float) + 0.0  # minus zero equals zero
                if len(v) not in known:
                    known[len(v)] = directions(len(v), m)
                p.append(((v / np.linalg.norm(v)) @ known[len(v)]).astype(np.float32))
                keys.append(xxhash.xxh3_128_digest(v.tobytes()))
                sizes.append(len(v))
            two = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            flat = pa.array(np.concatenate([np.zeros(0, np.float32), *p]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * m), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("vec_id"), b.column("label"), b.column("v"), pa.array(sizes, pa.int32()), pa.array(two[:, 0]), pa.array(two[:, 1]), lists],
                names=["row", "vec_id", "label", "v", "d", "k1", "k2", "p"],
            )

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"row long, vec_id {kind['vec_id']}, label string, v {kind['v']}, d int, k1 long, k2 long, p array<float>")


def blocks(classes: DataFrame, cuts: int, wide: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """classes dealt to blocks, and the pairs of blocks (x, y) that come within the wide window on all cutting projections."""
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = wide / 2
    cell = F.transform(F.slice("p", 1, cuts), lambda x: F.floor(x / width).cast("int"))
    dealt = classes.withColumns({"cell": cell, "at": F.element_at("p", cuts + 1)}).repartitionByRange(n, "label", "d", "cell", "at").sortWithinPartitions("label", "d", "cell", "at")
    # A block: rows of one partition and cell that follow one another.
    seq = F.monotonically_increasing_id()
    number = F.concat_ws("/", F.shiftright(seq, 33), F.floor(seq.bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK))
    block = F.concat_ws(":", "label", "d", F.array_join(F.col("cell").cast("array<string>"), ","), number)
    dealt = scratch.keep(dealt.withColumn("block", block), "blocks")
    spans = scratch.keep(dealt.groupBy("label", "d", "cell", "block").agg(F.min("at").alias("lo"), F.max("at").alias("hi")), "spans")
    # Every pair of cells from one of its sides: steps to itself and to cells after it in order.
    steps = [s for s in product(range(-2, 3), repeat=cuts) if s >= (0,) * cuts]
    there = F.explode(F.array(*[F.array(*map(F.lit, s)) if s else F.array().cast("array<int>") for s in steps]))
    a = spans.select("label", "d", F.col("block").alias("x"), F.col("cell").alias("own"), F.col("lo").alias("xl"), F.col("hi").alias("xh"), there.alias("step"))
    a = a.withColumn("cell", F.zip_with("own", "step", lambda c, s: c + s)).drop("step")
    pairs = a.join(spans.withColumnsRenamed({"block": "y", "lo": "yl", "hi": "yh"}), ["label", "d", "cell"])
    near = (F.col("xl") - wide <= F.col("yh")) & (F.col("yl") - wide <= F.col("xh")) & ((F.col("own") != F.col("cell")) | (F.col("x") <= F.col("y")))
    return dealt, pairs.where(near).select("x", "y")


def compared(units: DataFrame, cosine: float, needed: int, half: float, wide: float, order: int) -> DataFrame:
    """For units (x, y, side: 0 of x, 1 of y, 2 of both), counts of links (a, n) and links that join components (a, b)."""

    def run(_: tuple, unit: pa.Table) -> pa.Table:
        side = unit.column("side").to_numpy()
        cls, mult = unit.column("cls").to_numpy(), unit.column("mult").to_numpy()
        v = np.stack(unit.column("v").to_numpy(zero_copy_only=False)).astype(float)
        p = np.stack(unit.column("p").to_numpy(zero_copy_only=False))
        norm = np.linalg.norm(v, axis=1)
        xs, ys = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        ys = ys[np.argsort(p[ys, order], kind="stable")]
        sorted_, columns = p[ys, order], np.ascontiguousarray(p[ys].T)
        count, root, links = np.zeros(len(cls), np.int64), np.arange(len(cls)), []
        xs = xs[np.argsort(p[xs, order], kind="stable")]
        for start in range(0, len(xs), STEP):
            some = xs[start : start + STEP]
            lo = int(np.searchsorted(sorted_, p[some[0], order] - np.float32(wide), "left"))
            hi = int(np.searchsorted(sorted_, p[some[-1], order] + np.float32(wide), "right"))
            shared = np.zeros((len(some), hi - lo), np.int8)
            for k in range(p.shape[1]):
                shared += np.abs(columns[k, lo:hi] - p[some, k, None]) <= half
            hit = shared >= needed
            for i in np.flatnonzero(hit.any(1)):
                x, at = some[i], ys[lo:hi][hit[i]]
                at = at[at > x] if side[x] == 2 else at
                at = at[(v[at] @ v[x]) / (norm[at] * norm[x]) >= cosine]
                if not len(at):
                    continue
                count[x] += mult[at].sum()
                count[at] += mult[x]
                roots, where = np.unique(root[at], return_index=True)
                for r, y in zip(roots, at[where], strict=True):
                    if r != root[x]:
                        links.append((int(cls[x]), int(cls[y])))
                        root[root == r] = root[x]
        some = np.flatnonzero(count)
        return pa.table({
            "a": pa.array([*cls[some].tolist(), *(x for x, _ in links)], pa.int64()),
            "b": pa.array([None] * len(some) + [y for _, y in links], pa.int64()),
            "n": pa.array([*count[some].tolist(), *[None] * len(links)], pa.int64()),
        })

    return units.groupBy("x", "y").applyInArrow(run, "a long, b long, n long")


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS // 10 else df


def linked_vectors(vectors: DataFrame, cosine: float = 0.98, m: int = PROJECTIONS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null and the cosine of their embeddings, in double precision,
    is at least cosine. n_links counts the other rows a row is linked with; component_id is the smallest vec_id
    reachable. A vector that is null, empty or zero, or holds a null or a number that is not finite, is linked with
    nothing, and vectors of different lengths are not linked. Repeated rows are linked with each other. Other columns
    are ignored; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "projections")
    sigma = sqrt(2 - 2 * cosine)
    half, wide = np.float32(WINDOW * sigma), CUT * sigma
    v = F.col("embedding")
    double = v.cast("array<double>")
    fine = F.col("label").isNotNull() & F.coalesce(
        (F.size(v) > 0) & ~F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(double, lambda x: x != 0), F.lit(False)
    )
    given = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("string").alias("label"), v.alias("v"), fine.alias("fine"))
    rows = scratch.keep(projected(given.where("fine").drop("fine"), m), "rows")
    alone = given.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))

    # Equal vectors: all but the first row of a class are left out of the search.
    key = ["label", "d", "k1", "k2"]
    many = rows.groupBy(*key).agg(F.min("row").alias("cls"), F.count("*").alias("mult")).where("mult > 1")
    many = scratch.keep(rows.select("row", *key).join(many, key).select("row", "cls", "mult"), "many")
    firsts, rest = many.where("row = cls").select("row", "mult"), many.where("row <> cls")
    classes = rows.join(small(rest.select("row")), "row", "left_anti").join(small(firsts), "row", "left")
    classes = scratch.keep(classes.select(F.col("row").alias("cls"), F.coalesce("mult", F.lit(1)).cast("long").alias("mult"), "label", "d", "v", "p"), "classes")

    most = classes.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 0
    cuts = min(CUTS, m - 1, ceil(log(most / block, 6))) if most > block else 0
    dealt, pairs = blocks(classes, cuts, wide, scratch)
    sides = F.explode(F.when(F.col("x") == F.col("y"), F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side")
    sides = pairs.select("x", "y", sides).withColumns({"block": F.when(F.col("side") == 1, F.col("y")).otherwise(F.col("x"))})
    # What the other block spans on the cutting projections; a vector outside of that and its window is not sent there.
    reach = [c for k in range(cuts + 1) for c in (F.min(F.element_at("p", k + 1)).alias(f"lo{k}"), F.max(F.element_at("p", k + 1)).alias(f"hi{k}"))]
    boxes = small(scratch.keep(dealt.groupBy(F.col("block").alias("other")).agg(*reach), "boxes"))
    sides = sides.withColumn("other", F.when(F.col("side") == 1, F.col("x")).otherwise(F.col("y"))).join(boxes, "other")
    sides = scratch.keep(sides, "sides")
    units = dealt.select("block", "cls", "mult", "v", "p").join(small(sides), "block")
    for k in range(cuts + 1):
        units = units.where(F.element_at("p", k + 1).between(F.col(f"lo{k}") - wide, F.col(f"hi{k}") + wide))
    units = units.select("x", "y", "side", "cls", "mult", "v", "p")
    found = scratch.keep(compared(units, cosine, count_needed(m), half, wide, cuts), "found")

    comps = components(found.where("b IS NOT NULL").select("a", "b"), scratch).withColumnRenamed("id", "cls")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    linked = scratch.keep(counts.join(comps, "cls", "full").withColumnRenamed("cls", "class"), "linked")
    of = rows.select("row", "vec_id").join(small(many), "row", "left").withColumn("class", F.coalesce("cls", "row"))
    of = of.join(small(linked), "class", "left")
    of = scratch.keep(of.select("vec_id", F.coalesce("component", "class").alias("comp"), (F.coalesce("n", F.lit(0)) + F.coalesce("mult", F.lit(1)) - 1).alias("n_links")), "of")
    # Vectors that are linked with none need no join; the others find the smallest vec_id of their component.
    least = scratch.keep(of.where("n_links > 0").groupBy("comp").agg(F.min("vec_id").alias("component_id")), "least")
    out = of.where("n_links > 0").join(small(least), "comp").select("vec_id", "n_links", "component_id")
    single = of.where("n_links = 0").select("vec_id", "n_links", F.col("vec_id").alias("component_id"))
    return out.unionByName(single).unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
