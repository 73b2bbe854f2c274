"""Toxic spans by a linear-chain conditional random field of two states, clean and toxic.

Labels mark documents only, so token labels are derived first: in a toxic document, a word is toxic that has a feature
(itself, a start or an end of it) which labelled documents show far more often on the toxic side. The field is then
fitted to these tokens: each token's score for the toxic state is the sum of the weights of its own features and of its
two neighbours' words, and four weights join the states of neighbouring tokens. Forward and backward ratios give the
marginal of every token; a logistic function of the largest marginal, of their sum and of the text's length scores the document, and runs of
tokens whose marginal is at least one half are the offending spans.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mapped, slices

#: Labelled rows of either kind that the field is fitted to: the bound of the training sample.
TOXIC_ROWS, CLEAN_ROWS = 1500, 2000
#: Hashed weights for each of: a token's own features, the word before it, the word after it.
WEIGHTS = 1 << 18
OWN = 8
#: Tokens whose chains are laid out together while the field is fitted (more only for a longer document).
FIT_TOKENS = 400_000
#: Share of the toxic documents that a feature must be in (three at least) to mark its words as toxic.
SUPPORT = 0.015
#: Distinct tokens that a task remembers, about 300 bytes each, and bytes of texts that it scores together.
WORDS, BATCH = 250_000, 2_000_000
EDGE = re.compile(r"^\W+|\W+$")
TOKEN = re.compile(r"\S+")


def features(token: str) -> list[int]:
    """Hashed own features of a token: the word, starts of 3 to 6 letters, ends of 3 to 5; the word comes first."""
    w = EDGE.sub("", token).lower()
    found = [f"w={w}"] + [f"p={w[:k]}" if len(w) > k else "" for k in (3, 4, 5, 6)] + [f"s={w[-k:]}" if len(w) > k else "" for k in (3, 4, 5)]
    return [crc32(f.encode()) % (WEIGHTS - 1) + 1 if f else 0 for f in found]


class Words:
    """Numbers distinct tokens and keeps their features."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, OWN), np.int32)
        self.ends = np.zeros(1024, bool)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        get = self.place.get
        out = [get(t, -1) for t in tokens]
        if -1 in out:
            for t in dict.fromkeys(t for t, i in zip(tokens, out, strict=True) if i < 0):
                n = self.place[t] = len(self.place)
                if n == len(self.table):
                    self.table = np.vstack([self.table, np.zeros_like(self.table)])
                    self.ends = np.r_[self.ends, np.zeros_like(self.ends)]
                self.table[n], self.ends[n] = features(t), t[-1] in ".!?"
            out = [get(t) for t in tokens]
        return np.array(out, np.int32)


class Chains:
    """Tokens of several documents cut to sentences, laid out by time: at each step the chains that last so long."""

    def __init__(self, numbers: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> None:
        """numbers: tokens of all documents, one after the other; sizes: tokens of each."""
        n, self.docs = len(numbers), len(sizes)
        self.n = n
        numbers = numbers.astype(np.int32)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        stop = ends[numbers].copy() if n else np.zeros(0, bool)
        stop[np.cumsum(sizes)[sizes > 0] - 1] = True
        start = np.r_[True, stop[:-1]][:n]
        at = np.flatnonzero(start).astype(np.int32)
        lengths = np.diff(np.append(at, np.int32(n)))
        order = np.argsort(-lengths, kind="stable")
        at, lengths = at[order], lengths[order]
        counts = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths.max(initial=0)))]
        self.steps = [at[:c] + np.int32(t) for t, c in enumerate(counts)]
        left, right = np.zeros(n, np.int32), np.zeros(n, np.int32)
        left[1:], right[:-1] = numbers[:-1], numbers[1:]
        self.numbers, self.left, self.right = numbers, left, right
        self.has_left, self.has_right = ~start, ~np.r_[start[1:], True][:n]

    def scores(self, own: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of every token for the toxic state, from the scores of its word alone, as left and as right neighbour."""
        return np.clip(own[self.numbers] + left[self.left] * self.has_left + right[self.right] * self.has_right, -30, 30)

    def marginals(self, e: np.ndarray, joint: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the toxic state of every token; pairs: expected counts of neighbouring states too."""
        x, a = np.exp(e), np.exp(joint)
        r, q = np.empty(self.n), np.ones(self.n)
        for t, at in enumerate(self.steps):
            before = r[at - 1] if t else None
            r[at] = x[at] * (1.0 if t == 0 else (a[0, 1] + before * a[1, 1]) / (a[0, 0] + before * a[1, 0]))
        for t in range(len(self.steps) - 1, 0, -1):
            at = self.steps[t]
            y = x[at] * q[at]
            q[at - 1] = (a[1, 0] + a[1, 1] * y) / (a[0, 0] + a[0, 1] * y)
        m = r * q
        expected = np.zeros((2, 2))
        if pairs and len(self.steps) > 1:
            for lo in range(0, self.n, 100_000):  # tokens that have one before them in their chain
                at = lo + np.flatnonzero(self.has_left[lo : lo + 100_000])
                y, before = x[at] * q[at], r[at - 1]
                w = np.stack([np.full(len(at), a[0, 0]), a[0, 1] * y, before * a[1, 0], before * a[1, 1] * y])
                expected += (w / w.sum(0)).sum(1).reshape(2, 2)
        return m / (1 + m), expected


def summary(m: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document: largest marginal, logs of the sum of those that matter and of the number of tokens, one."""
    top = np.zeros(n)
    np.maximum.at(top, doc, m)
    total = np.bincount(doc, np.where(m > 0.1, m, 0), n)
    return np.stack([top, np.log1p(total), np.log1p(np.bincount(doc, minlength=n)), np.ones(n)], 1)


class Model:
    """Weights; prior is the score of every document where there was nothing to learn from."""

    def __init__(self, prior: float = 0.0) -> None:
        self.prior, self.joint, self.final = prior, np.zeros((2, 2)), None
        self.own, self.left, self.right = (np.zeros(WEIGHTS, np.float32) for _ in range(3))

    def word_scores(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.own[table].sum(1) + self.bias, self.left[table[:, 0]], self.right[table[:, 0]]

    bias = 0.0

    def fit(self, texts: list[str], labels: np.ndarray, weights: np.ndarray, rounds: int = 30) -> Model:
        """weights: how many documents of the whole a row of the sample stands for."""
        words = Words()
        docs = [words.numbers(t.split()) for t in texts]
        sizes = np.array([len(d) for d in docs], np.int64)
        table = words.table[: len(words.place)].copy()
        ends, toxic_word = words.ends, self.suspicious(table, docs, labels)
        del words
        # Chains of whole documents, about FIT_TOKENS tokens at a time; those that are toxic are marked.
        block = (np.cumsum(sizes) - sizes) // FIT_TOKENS
        parts, seen = [], np.zeros((2, 2))
        for lo, hi in pairwise(np.flatnonzero(np.r_[True, np.diff(block) > 0, True][: len(sizes)]).tolist() + [len(sizes)]):
            numbers = np.concatenate([*docs[lo:hi], np.zeros(0, np.int32)])
            docs[lo:hi] = [None] * (hi - lo)
            c = Chains(numbers, ends, sizes[lo:hi])
            y = toxic_word[numbers] & (labels[lo:hi][c.doc] == 1)
            at = np.flatnonzero(c.has_left)
            seen += np.bincount(y[at - 1] * np.int8(2) + y[at], minlength=4).reshape(2, 2)
            parts.append((c, y))
        if not any(y.any() for _, y in parts):
            return self
        flat = table.ravel()
        self.bias = -3.0
        grads: list = [0.0, 0.0, 0.0, 0.0, 0.0]
        for _ in range(rounds):
            by_word, total, expected = np.zeros(len(table)), 0.0, np.zeros((2, 2))
            lefts, rights = np.zeros(WEIGHTS), np.zeros(WEIGHTS)
            known = self.word_scores(table)
            for c, y in parts:
                m, pairs = c.marginals(c.scores(*known), self.joint, pairs=True)
                d = y - m
                by_word += np.bincount(c.numbers, d, len(table))
                lefts += np.bincount(table[c.left, 0], d * c.has_left, WEIGHTS)
                rights += np.bincount(table[c.right, 0], d * c.has_right, WEIGHTS)
                expected, total = expected + pairs, total + d.sum()
            g = [
                np.bincount(flat, np.repeat(by_word, OWN), WEIGHTS) - 1.0 * self.own,
                lefts - 0.5 * self.left,
                rights - 0.5 * self.right,
                seen - expected - 0.1 * self.joint,
                total,
            ]
            grads = [s + np.square(x) for s, x in zip(grads, g, strict=True)]
            g = [0.5 * x / (np.sqrt(s) + 1e-6) for s, x in zip(grads, g, strict=True)]
            g[0][0] = 0
            self.own, self.left, self.right = self.own + g[0], self.left + g[1], self.right + g[2]
            self.joint, self.bias = self.joint + g[3], self.bias + g[4]
        known = self.word_scores(table)
        x = np.concatenate([summary(c.marginals(c.scores(*known), self.joint)[0], c.doc, c.docs) for c, _ in parts])
        ridge, f = np.array([0.5, 0.5, 0.5, 0.01]), np.array([1.0, 1.0, 0.0, -2.0])
        for _ in range(60):  # Newton's method, with a light ridge
            p = 1 / (1 + np.exp(-np.clip(x @ f, -30, 30)))
            h = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            f = f + 0.5 * np.linalg.solve(h, x.T @ (weights * (labels - p)) - ridge * f)
        self.final = f
        for k in ("own", "left", "right"):
            setattr(self, k, getattr(self, k).astype(np.float32))
        return self

    @staticmethod
    def suspicious(table: np.ndarray, docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
        """Tokens with a feature in SUPPORT of the toxic documents, 20 times likelier there, and too often for chance.

        Chance: the likelihood ratio of the feature's share of toxic documents against theirs among all must be larger
        than the number of features tried.
        """
        counts = np.zeros((2, WEIGHTS))
        for d, y in zip(docs, labels, strict=True):
            counts[int(y), np.unique(table[np.unique(d)])] += 1
        n = np.array([(labels == 0).sum(), (labels == 1).sum()])
        odds = ((counts[1] + 0.5) / (n[1] + 1)) / ((counts[0] + 0.5) / (n[0] + 1))
        share, total = n[1] / n.sum(), counts.sum(0)
        q = np.clip(counts[1] / np.maximum(total, 1), 1e-9, 1 - 1e-9)
        gain = total * (q * np.log(q / share) + (1 - q) * np.log((1 - q) / (1 - share)))
        bad = (odds > 20) & (counts[1] >= max(3, SUPPORT * n[1])) & (gain > np.log(max(1, (total > 0).sum())))
        bad[0] = False
        return bad[table].any(1)

    def score(self, texts: list[str], words: Words, known: list[np.ndarray]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Scores of texts and their offending spans (code points, end exclusive). known: scores of words so far."""
        if self.final is None:
            return np.full(len(texts), self.prior), [[] for _ in texts]
        tokens = [t.split() for t in texts]
        sizes = np.array([len(t) for t in tokens], np.int64)
        numbers = words.numbers([w for t in tokens for w in t])
        if len(words.place) > len(known[0]):
            new = self.word_scores(words.table[len(known[0]) : len(words.place)])
            known[:] = [np.concatenate(x) for x in zip(known, new, strict=True)]
        chains = Chains(numbers, words.ends, sizes)
        m, _ = chains.marginals(chains.scores(*known), self.joint)
        score = 1 / (1 + np.exp(-np.clip(summary(m, chains.doc, len(texts)) @ self.final, -30, 30)))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        bad, first = m >= 0.5, np.cumsum(sizes) - sizes
        for i in np.unique(chains.doc[bad]):
            marks = bad[first[i] : first[i] + sizes[i]]
            last = -2
            for k, at in enumerate(TOKEN.finditer(texts[i])):
                if marks[k]:
                    spans[i].append((spans[i].pop()[0], at.end()) if last == k - 1 else at.span())
                    last = k
        return score, spans


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """The field for docs (doc_id, text) and labels (doc_id, toxic 0 or 1), fitted to at most so many rows of either kind.

    Of labels repeated for a document the largest counts. The sample are the labelled documents whose doc_id has the
    smallest hashes: only numbers are joined and sorted, and the texts of the sample are picked by a broadcast of its
    bounded number of doc_ids. One task fits; the model that comes back has a fixed size.
    """
    marked = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select("doc_id").join(marked, "doc_id").distinct()
    counts = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        return Model(float(n1 > 0))
    picked = [ids.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for kind, limit in ((1, toxic_rows), (0, clean_rows))]
    picked = Scratch(docs.sparkSession, "sample").keep(picked[0].unionByName(picked[1]))
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic").repartition(1).sortWithinPartitions("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, kinds = [], []
        for b in batches:
            texts += [t or "" for t in b.column(0).to_pylist()]
            kinds += b.column(1).to_pylist()
        y = np.array(kinds)
        weights = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum())) / ((n0 + n1) / len(y))
        model = Model(n1 / (n0 + n1)).fit(texts, y, weights)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], names=["model"])

    return pickle.loads(mapped(sample, run, "model binary").first()["model"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score double (0 to 1) and spans (offending code points, array of start, end), for every row.

    Scores come from text alone. A null or empty text has no tokens and the score of a document without toxic tokens;
    repeated rows score alike; columns named score and spans are replaced.
    """
    docs = docs.drop("score", "spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = Words(), [np.zeros(0)] * 3
        for b in slices(batches, BATCH, "text"):
            if len(words.place) > WORDS:
                words, known = Words(), [np.zeros(0)] * 3
            score, spans = shared.value.score([t or "" for t in b.column(at).to_pylist()], words, known)
            found = pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], SPANS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), found], names=[*b.schema.names, "score", "spans"])

    from pyspark.sql import types as T

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    return mapped(docs, run, schema)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
