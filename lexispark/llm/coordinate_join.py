"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures.

1. Documents with equal shingle sets are one class. Every class is posted under each of its K pairs (coordinate, value).
2. A pair of classes counts as a candidate if it agrees in `match` coordinates; a linked pair reaches that number but
   once in a million. Of the postings that are shared at all, sorted by how rare they are, two candidates must have one
   in common among the first s - match + 1 of each (prefix merging), so only these are kept.
3. Each remaining posting list names as its leader the class whose values are the most frequent: in a group of edited
   copies that is the original. Members are compared with their leaders; what is linked already is skipped from then on
   (skip merging): only members outside their leader's component are compared with the other members of its lists, in
   blocks of bounded size. Candidates are confirmed on full shingle sets, read again from the documents.

Every candidate pair shares a list and so a leader; it is confirmed, or both its ends are in one component already, or
one end lies outside the leader's component and is compared with the other. So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, mapped, slices
from .components import components

K = 64
#: A pair at the threshold misses the match count with at most this probability.
MISS = 1e-6
#: Shingles of the members, and of those compared with them, that a block holds (more only for a longer document).
MEMBER_BLOCK, QUERY_BLOCK = 500_000, 250_000
#: Bytes of texts that are shingled together (more only for a longer text).
BATCH = 8_000_000


def match_count(similarity: float, k: int = K, miss: float = MISS) -> int:
    """The largest count that a pair of this similarity fails to reach with at most probability miss."""
    total, t = 0.0, 0
    while t < k:
        total += comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if total > miss:
            return max(1, t)
        t += 1
    return k


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text, sorted distinct 64-bit hashes of its word n-grams; with fewer words, of the whole sequence; without any, none.

    Arrow splits the words, and each distinct one is hashed once; nothing is kept from batch to batch. (Lower case is not
    taken of 64-bit strings: Arrow's kernel misreads slices of these.)
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, bounds = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    some = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at an end leaves an empty word
    bounds = np.r_[0, np.cumsum(some)][bounds]
    words = words.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    h = hashes[words.indices.to_numpy()[some]]

    def grams(h: np.ndarray, n: int) -> np.ndarray:
        out = np.full(max(0, len(h) - n + 1), n, np.uint64)
        for i in range(n):
            out = (out ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return out

    # Those that run over a text's end are not read.
    every = grams(h, size)
    found = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found.append(np.unique(every[lo : hi - size + 1] if hi - lo >= size else grams(h[lo:hi], hi - lo) if hi > lo else every[:0]))
    return found


def multipliers(k: int) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(row, doc_id, n, k1, k2, sig) of every document: set size, 128-bit hash of the set, k minima."""
    factors = multipliers(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BATCH, "text"):
            n, keys, sigs = [], [], []
            for s in shingle_sets(b.column(2), size):
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig = np.full(k, np.uint32(0xFFFFFFFF))
                for lo in range(0, len(s), 4096):
                    np.minimum(sig, (s[lo : lo + 4096, None].astype(np.uint32) * factors).min(0), out=sig)
                sigs.append(sig.view(np.int32))
            two = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            flat = pa.array(np.concatenate([*sigs, np.zeros(0, np.int32)]), pa.int32())
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * k), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]), sig], names=["row", "doc_id", "n", "k1", "k2", "sig"]
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return mapped(rows, run, f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, k1 long, k2 long, sig array<int>")


def linked(inter: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def confirm(units: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between queries and members of the same unit that lie in different components.

    units (leader, bx, bm, query boolean, cls, comp); texts (cls, text). A unit's links join components once each.
    """

    def run(_: tuple, unit: pa.Table) -> pa.Table:
        query = unit.column("query").to_numpy(zero_copy_only=False)
        cls, comp = unit.column("cls").to_numpy(), unit.column("comp").to_numpy()
        sets = shingle_sets(unit.column("text").combine_chunks(), size)
        members = np.flatnonzero(~query)
        owner = np.repeat(np.arange(len(members)), [len(sets[i]) for i in members])
        flat = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in members)])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        sizes = np.array([len(sets[i]) for i in members], np.int64)
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        out = []
        for q in np.flatnonzero(query):
            lo, hi = np.searchsorted(flat, sets[q], "left"), np.searchsorted(flat, sets[q], "right")
            n = hi - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            inter = np.bincount(owner[at], minlength=len(members))
            for j in np.flatnonzero(linked(inter, len(sets[q]), sizes, percent) & (inter > 0)):
                m = members[j]
                x, y = root(int(comp[q])), root(int(comp[m]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((int(cls[q]), int(cls[m])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return units.join(texts, "cls").groupBy("leader", "bx", "bm").applyInArrow(run, "a long, b long")


def near(units: DataFrame, match: int) -> DataFrame:
    """The rows of units whose signature agrees with that of one on the other side, of another component, often enough."""

    def run(_: tuple, unit: pa.Table) -> pa.Table:
        query = unit.column("query").to_numpy(zero_copy_only=False)
        comp = unit.column("comp").to_numpy()
        sig = np.array(unit.column("sig").to_pylist(), np.int32).reshape(len(query), -1)
        xs, ms = np.flatnonzero(query), np.flatnonzero(~query)
        hit, columns = np.zeros(len(query), bool), np.ascontiguousarray(sig[ms].T)
        for x in xs:
            count = np.zeros(len(ms), np.int16)
            for k in range(sig.shape[1]):
                count += columns[k] == sig[x, k]
            good = (count >= match) & (comp[ms] != comp[x])
            if good.any():
                hit[x] = True
                hit[ms[good]] = True
        return unit.drop_columns(["sig"]).filter(pa.array(hit))

    schema = "leader long, bx int, bm int, query boolean, cls long, comp long"
    return units.select("leader", "bx", "bm", "query", "cls", "comp", "sig").groupBy("leader", "bx", "bm").applyInArrow(run, schema)


def blocks(rows: DataFrame, match: int, classes: DataFrame) -> DataFrame:
    """Units of queries and members in blocks: every query of a leader meets every member, in one block each.

    rows (leader, cls, comp, n, query boolean): a query row may be a member's too.
    """
    sizes = rows.groupBy("leader").agg(
        F.ceil(F.sum(F.when(F.col("query"), F.col("n"))) / QUERY_BLOCK).cast("int").alias("nx"),
        F.ceil(F.sum(F.when(~F.col("query"), F.col("n"))) / MEMBER_BLOCK).cast("int").alias("nm"),
    )
    dealt = rows.join(sizes.dropna(), "leader")
    some = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    xs = dealt.where("query").select("leader", own("nx").alias("bx"), some("nm").alias("bm"), "query", "cls", "comp")
    ms = dealt.where("not query").select("leader", some("nx").alias("bx"), own("nm").alias("bm"), "query", "cls", "comp")
    return near(xs.unionByName(ms).join(classes.select("cls", "sig"), "cls"), match)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, k: int = K, miss: float = MISS) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept, keeper) for every row of docs (doc_id, text); row is its place.

    Two documents are linked if 100 * intersection >= percent * union of their sets of word n-grams of this size
    (a document with fewer words has its whole sequence as the one shingle). Words lie between ASCII white space, A-Z
    count as a-z. component_id is the smallest doc_id reachable and kept says whether it is the row's own. Documents
    without words, or with null text, are linked with nothing. Repeated rows are linked with each other and kept alike;
    keeper is true for one row of each component only.
    """
    scratch = Scratch(docs.sparkSession, "coordinates")
    match = match_count(percent / 100, k, miss)
    rows = scratch.keep(signatures(docs, size, k), "rows")
    classes = scratch.keep(
        rows.where("n > 0").groupBy("k1", "k2").agg(
            F.min("row").alias("cls"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "classes",
    )
    posts = classes.select("cls", F.posexplode("sig").alias("coordinate", "value")).select(
        "cls", F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key")
    )
    shared = posts.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    # At most k entries a class.
    prefix = (
        posts.join(shared, "key").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("f", "key"))).alias("p"), F.sum("f").alias("popular"))
        .where(F.size("p") >= match)
        .select("cls", "popular", F.explode(F.slice("p", F.lit(1), F.size("p") - match + 1)).alias("x"))
        .select("cls", "popular", F.col("x.key").alias("key"))
    )
    prefix = scratch.keep(prefix, "prefix")
    leaders = prefix.groupBy("key").agg(F.max(F.struct("popular", (-F.col("cls")).alias("c"))).alias("x"), F.count("*").alias("f")).where("f > 1")
    groups = scratch.keep(
        prefix.join(leaders.select("key", (-F.col("x.c")).alias("leader"), "f"), "key").groupBy("leader", "cls").agg(F.max("f").alias("f"))
        .join(classes.select("cls", "n"), "cls"),
        "groups",
    )
    scratch.drop(prefix)
    agree = F.aggregate(F.zip_with("sig", "leader_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    stars = groups.where("leader != cls").join(classes.select("cls", "sig"), "cls")
    stars = stars.join(classes.select(F.col("cls").alias("leader"), F.col("sig").alias("leader_sig")), "leader").where(agree >= match)
    stars = scratch.keep(stars.select("leader", "cls", F.col("cls").alias("comp"), "n", F.lit(False).alias("query")), "stars")
    heads = stars.select("leader").distinct().withColumn("cls", F.col("leader")).join(classes.select("cls", "n"), "cls")
    heads = heads.withColumns({"comp": F.col("cls"), "query": F.lit(True)})
    cols = ["leader", "cls", "comp", "n", "query"]

    def confirmed(rows: DataFrame) -> DataFrame:
        units = scratch.keep(blocks(rows, match, classes), "units")
        cand = units.select("cls").distinct().join(classes.select("cls", "doc_id", "k1", "k2"), "cls")
        return scratch.keep(confirm(units, class_texts(docs, cand, size), size, percent), "confirmed")

    first = confirmed(stars.select(cols).unionByName(heads.select(cols)))
    comps = components(first, scratch)

    # A list of two has no pair but the one with its leader.
    groups = groups.where("f > 2 or leader = cls")
    known = groups.join(comps.withColumnRenamed("id", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
    heads = groups.select("leader").distinct().join(comps.withColumnRenamed("id", "leader"), "leader", "left")
    heads = heads.select("leader", F.coalesce("component", "leader").alias("head"))
    known = scratch.keep(known.join(heads, "leader"), "known")
    outside = known.where("comp != head").select("leader", "cls", "comp", "n", F.lit(True).alias("query"))
    some = known.join(outside.select("leader").distinct(), "leader").where("cls != leader").select("leader", "cls", "comp", "n", F.lit(False).alias("query"))
    second = confirmed(outside.unionByName(some))
    comps = components(first.unionByName(second), scratch)

    of = rows.where("n > 0").join(classes.select("k1", "k2", "cls"), ["k1", "k2"]).join(comps.withColumnRenamed("id", "cls"), "cls", "left")
    of = of.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "cls").alias("comp"))
    first_of = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = of.groupBy("comp").agg(F.min(first_of).alias("least")).select("comp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("keeper"))
    out = of.join(least, "comp").drop("comp").withColumn("keeper", F.col("row") == F.col("keeper"))
    alone = rows.where("n = 0").select("row", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group: the first row of the smallest doc_id. Rows without words all stay.

    docs must give the same rows in the same order each time it is read, as files do.
    """
    found = near_duplicates(docs.select("doc_id", "text"), size, percent)
    gone = Scratch(docs.sparkSession, "gone").keep(found.where("not keeper").select(F.col("row").alias("_row")), "gone")
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "_row", "left_anti").drop("_row")


def class_texts(docs: DataFrame, cand: DataFrame, size: int) -> DataFrame:
    """(cls, text): for each class of cand (cls, doc_id, k1, k2) the text of a document that has its number and set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BATCH, "text"):
            same = [
                xxhash.xxh3_128_digest(s.tobytes()) == np.array([x, y], np.int64).tobytes()
                for s, x, y in zip(shingle_sets(b.column("text"), size), b.column("k1").to_pylist(), b.column("k2").to_pylist(), strict=True)
            ]
            yield b.select(["cls", "text"]).filter(pa.array(same, pa.bool_()))

    rows = docs.select("doc_id", "text")
    if cand.count() <= BROADCAST_ROWS:
        ids = cand.select(F.col("doc_id").alias("id")).distinct()
        rows = rows.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    found = mapped(rows.join(cand, rows["doc_id"].eqNullSafe(cand["doc_id"])).select("cls", "text", "k1", "k2"), run, "cls long, text string")
    return found.dropDuplicates(["cls"])
