"""Benchmark phrases in documents by an FM-index over each shard of the training text.

A shard is a bounded number of words of one task's documents. Its text is the sequence of word numbers, without the
stretches that no phrase can touch (words that no phrase has, and stretches shorter than the shortest phrase); equal
texts are indexed once. The phrases are then searched backward, all at once, with ranks from a wavelet matrix, and
occurrences are located by walking to sampled suffix positions. Spans that overlap or touch are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mapped, slices

#: Words in an index, six bytes each; a longer document has one of its own.
SHARD_WORDS = 500_000
#: Every so many text positions a suffix position is kept.
SAMPLE = 16
#: Distinct windows that are broadcast and searched at a time.
BLOCK = 200_000

#: A-Z in lower case, every byte that is not part of a word as a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Sorted suffixes of t by prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    rank = np.empty(n, np.int64)

    def ranks(at: np.ndarray, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Gives the places first + ... in order of keys to the suffixes at; says which are still tied."""
        new = np.r_[True, keys[1:] != keys[:-1]]
        start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank[at] = first[start]
        return ~(new & np.r_[new[1:], True])

    tied = ranks(sa, t[sa], np.arange(n))
    at, slots, h = sa[tied], np.arange(n)[tied], 1
    while len(at):
        nxt = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        keys = rank[at] * (n + 1) + nxt
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        sa[slots] = at
        tied = ranks(at, keys, slots)
        at, slots, h = at[tied], slots[tied], h * 2
    return sa


class Wavelet:
    """Wavelet matrix: rank(c, i) counts c among the first i symbols."""

    def __init__(self, x: np.ndarray, top: int) -> None:
        self.depth = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = (x >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(int(len(x) - bit.sum()))
            x = np.concatenate([x[bit == 0], x[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros(len(c), np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = (c >> (self.depth - 1 - k)) & 1 == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            i = np.where(one, zeros + ones[i], i - ones[i])
        return i - start


class FMIndex:
    def __init__(self, t: np.ndarray, top: int) -> None:
        """t: symbols from 0 to top; 0 separates passages and occurs in no phrase."""
        t = np.append(t + 1, 0)  # the end is a symbol of its own and the smallest suffix
        sa = suffix_array(t)
        self.n, self.bwt = len(t), t[sa - 1]
        self.ranks = Wavelet(self.bwt, top + 1)
        self.before = np.r_[0, np.cumsum(np.bincount(t, minlength=top + 2))]
        kept = sa % SAMPLE == 0
        self.rows, self.at = np.flatnonzero(kept), sa[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of phrases (right-aligned symbols, so that all end in the last column)."""
        s, e = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1]):
            live = live[(lengths[live] <= j) | (s[live] < e[live])]
            at = live[lengths[live] > j]
            if not len(at):
                break
            c = phrases[at, phrases.shape[1] - 1 - j] + 1
            s[at] = self.before[c] + self.ranks.rank(c, s[at])
            e[at] = self.before[c] + self.ranks.rank(c, e[at])
        return s, np.maximum(s, e)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: each walks back until a sampled position."""
        out, steps, todo = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            k = np.minimum(np.searchsorted(self.rows, rows[todo]), len(self.rows) - 1)
            found = self.rows[k] == rows[todo]
            out[todo[found]] = self.at[k[found]] + steps
            todo = todo[~found]
            c = self.bwt[rows[todo]]
            rows[todo] = self.before[c] + self.ranks.rank(c, rows[todo])
            steps += 1
        return out


class Phrases:
    """Distinct windows of words, numbered, with the items each one belongs to."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]) -> None:
        vocabulary = sorted({w for x in windows for w in x})
        self.known = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.lengths = np.array([len(x) for x in windows], np.int64)
        self.items = list(windows.values())
        longest = int(self.lengths.max(initial=1))
        self.symbols = np.zeros((len(windows), longest), np.int64)
        for i, x in enumerate(windows):
            self.symbols[i, longest - len(x) :] = [self.known[w] for w in x]
        self.shortest = int(self.lengths.min(initial=1))

    def find(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: number of words, merged spans of word places (end exclusive), items found."""
        place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        counts, passages, owners, starts = [], [], [], []
        get = self.known.get
        for i, text in enumerate(place):
            ws = words(text)
            counts.append(len(ws))
            ids = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
            edge = np.flatnonzero(np.diff(np.r_[0, ids != 0, 0]))
            for a, b in edge.reshape(-1, 2):
                if b - a >= self.shortest:
                    passages += [ids[a:b], np.zeros(1, np.int64)]
                    owners.append(i)
                    starts.append((int(a), int(b - a)))
        spans: list[list] = [[] for _ in place]
        items: list[set] = [set() for _ in place]
        if owners:
            index = FMIndex(np.concatenate(passages), len(self.known))
            s, e = index.search(self.symbols, self.lengths)
            count = e - s
            which = np.repeat(np.arange(len(s)), count)
            rows = np.repeat(s - np.cumsum(count) + count, count) + np.arange(len(which))
            first = np.cumsum([0] + [n + 1 for _, n in starts[:-1]])
            at = index.locate(rows)
            k = np.searchsorted(first, at, side="right") - 1
            for w, p, q in zip(which.tolist(), at.tolist(), k.tolist(), strict=True):
                lo = starts[q][0] + p - int(first[q])
                spans[owners[q]].append((lo, lo + int(self.lengths[w])))
                items[owners[q]].update(self.items[w])
        out = [(n, merged(x), sorted(y)) for n, x, y in zip(counts, spans, items, strict=True)]
        return [out[place[t]] for t in texts]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words in spans and what stands between them."""
    data, at = text.encode(), [m.span() for m in WORD.finditer(text.encode())]
    out, last = [], 0
    for lo, hi in spans:
        out.append(data[last : at[lo][0]])
        last = at[hi - 1][1]
    return b"".join([*out, data[last:]]).decode()


def windows_of(benchmark: DataFrame, n: int) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """The distinct windows of all items, in blocks of a bounded number."""
    block: dict[tuple[bytes, ...], list[str]] = {}
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        ws = words(text)
        for i in range(max(1, len(ws) - n + 1) if ws else 0):
            block.setdefault(tuple(ws[i : i + n]), []).append(item if item is not None else "")
        if len(block) >= BLOCK:
            yield block
            block = {}
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, spans, items) for every row of docs.

    Words are runs of ASCII letters and digits and of other signs beyond ASCII; A-Z count as a-z. A window is n
    consecutive words of an item, or a shorter item whole. spans are the merged places of words inside any occurrence
    of a window (array of start, end; end exclusive); items are the item_ids with an occurring window, as sorted
    strings. A null or empty text has no words; items without words have no windows; repeated rows are judged alike;
    with more windows than BLOCK the documents are searched once for each block.
    """
    found: DataFrame | None = None
    blocks = 0
    for block in windows_of(benchmark, n):
        if not block and found is not None:
            break
        shared = docs.sparkSession.sparkContext.broadcast(Phrases(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 6 * SHARD_WORDS, "_text"):
                got = shared.value.find(b.column("_text").to_pylist())
                spans = [[{"start": lo, "end": hi} for lo, hi in x] for _, x, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([x for x, _, _ in got], pa.int64()), pa.array(spans, SPANS), pa.array([x for _, _, x in got], pa.list_(pa.string()))],
                    names=["row", key, "n_words", "spans", "items"],
                )

        kind = docs.schema[key].dataType.simpleString()
        part = mapped(
            docs.select(F.monotonically_increasing_id().alias("row"), key, F.col(text).alias("_text")), run, f"row long, `{key}` {kind}, n_words long, spans array<struct<start: long, end: long>>, items array<string>"
        )
        found = part if found is None else found.unionByName(part)
        blocks += 1
    if blocks > 1:
        found = found.groupBy("row", key, "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
        )
        found = found.withColumn("spans", merged_column(F.array_sort("spans")))
    return found.drop("row")


def merged_column(spans):
    """merged() of a sorted array, in Catalyst."""
    return F.aggregate(
        spans,
        F.array().cast("array<struct<start: long, end: long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """docs with every hit word cut from text (again, until no window occurs); n_chars follows, if there is one.

    Each round cuts the merged spans of all windows at once, in however many blocks these are searched. Documents
    without a hit stay as they are; one whose text has nothing left is dropped.
    """
    blocks = windows_of(benchmark, n)
    first = next(blocks)
    out = cut_in_rounds(docs, benchmark, n) if next(blocks, None) else cut_by_block(docs, first)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def cut_by_block(docs: DataFrame, block: dict[tuple[bytes, ...], list[str]]) -> DataFrame:
    """decontaminated() for windows that are one block: all rounds in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(Phrases(block))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 6 * SHARD_WORDS, "text"):
            texts = b.column("text").to_pylist()
            todo = list(range(len(texts)))
            while todo:
                got = shared.value.find([texts[i] for i in todo])
                hit = [(i, spans) for i, (_, spans, _) in zip(todo, got, strict=True) if spans]
                for i, spans in hit:
                    texts[i] = cut(texts[i], spans) or None
                todo = [i for i, _ in hit]
            gone = [x is None and y is not None for x, y in zip(texts, b.column("text").to_pylist(), strict=True)]
            cols = [pa.array(texts, f.type) if i == at else c for i, (c, f) in enumerate(zip(b.columns, b.schema, strict=True))]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names).filter(pa.array([not x for x in gone]))

    return mapped(docs, run, docs.schema)


def cut_in_rounds(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """decontaminated() for windows of many blocks: a round searches all of them in the rows that the last one cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [cut(t, [(x["start"], x["end"]) for x in s]) or None for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("_cut_row"), pa.array(texts, pa.string())], names=["_cut_row", "text"])

    scratch = Scratch(docs.sparkSession, "cut")
    rows = scratch.keep(docs.withColumn("_cut_row", F.monotonically_increasing_id()), "rows")
    todo, cuts = rows.select("_cut_row", "text"), []
    while True:
        hits = contamination(todo, benchmark, n, key="_cut_row").where(F.size("spans") > 0).select("_cut_row", "spans")
        todo = scratch.keep(todo.join(hits, "_cut_row").select("_cut_row", "text", "spans").mapInArrow(run, "_cut_row long, text string"), "cut")
        if todo.isEmpty():
            break
        cuts.append(todo.select("_cut_row", F.struct("text").alias("_cut"), F.lit(len(cuts)).alias("_round")))
    if not cuts:
        return rows.select(*docs.columns)
    last = reduce(DataFrame.unionByName, cuts).groupBy("_cut_row").agg(F.max_by("_cut", "_round").alias("_cut"))
    out = rows.join(last, "_cut_row", "left").where(F.col("_cut").isNull() | F.col("_cut.text").isNotNull())
    return out.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.col("_cut.text"))).select(*docs.columns)
