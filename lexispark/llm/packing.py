"""Vector bin packing of token pieces into training sequences.

A task packs what it reads, so nothing is shuffled: documents are tokenized, cut and placed in one pass. Every piece
is a vector of tokens, segments and loss-bearing tokens; the open sequence has what is left of the three limits.
The dot-product heuristic gives it the waiting piece whose vector has the largest dot product with the room left, each
dimension divided by its limit. Where no waiting piece fits whole, the best one is cut to fill the room, which leaves
no padding but in a task's last sequence (or where the limits of segments or loss end a sequence).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices

#: Waiting pieces among which the heuristic chooses.
WINDOW = 64
#: UTF-8 bytes of texts that are tokenized together (more only for a longer text): the longer, the fewer words twice.
BATCH = 8_000_000
#: Signs that may end a word, and letters without combining marks (and without the one whose lower case has such a
#: mark): the pre-tokenizer cuts between the two, and nowhere within either's run.
SIGNS = "-.,;:!?$%&*#|()"
LETTERS = "^[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{12f}\\x{131}-\\x{2af}]+$"
#: Words that are given to the tokenizer as one text.
JOINED = 500

PIECES = "doc_id long, start long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


class WordTokenizer:
    """Token ids of texts by a tokenizers file with word ends that never joins two words over a space.

    The pre-tokenizer drops white space and the normalizer works within a word, so the ids of a text are those of its
    parts between spaces and line ends, one after the other. Arrow splits and numbers the words of a batch, and each
    distinct word is tokenized once; nothing is kept from batch to batch.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        found = [e.ids for lo in range(0, len(words), 2000) for e in self.tok.encode_batch_fast(words[lo : lo + 2000], add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """each() for words of letters: a word's last id is a word's end and no other of its ids is."""
        ids, sizes = [], []
        for lo in range(0, len(words), JOINED):
            some = words[lo : lo + JOINED]
            got = np.array(self.tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            n = np.diff(np.flatnonzero(np.r_[True, self.ends[got]]))
            if len(n) != len(some) or n.sum() != len(got):
                got, n = self.each(some)
            ids.append(got)
            sizes.append(n)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """each() for distinct words of any form, by their heads of letters and tails of signs where they have these."""
        heads = pc.utf8_rtrim(words, SIGNS)
        plain = pc.match_substring_regex(heads, LETTERS)
        some = words.filter(plain)
        heads = heads.filter(plain)
        tails = pa.array([w[len(h) :] for w, h in zip(some.to_pylist(), heads.to_pylist(), strict=True)], pa.string())
        heads, tails = pc.utf8_lower(heads).dictionary_encode(), tails.dictionary_encode()
        parts = [self.joined(heads.dictionary.to_pylist()), self.each(tails.dictionary.to_pylist()), self.each(words.filter(pc.invert(plain)).to_pylist())]
        pool, sizes = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        h, t = len(heads.dictionary), len(tails.dictionary)
        # A word is two entries of the pool: head and tail, or itself and nothing.
        sizes = np.append(sizes, 0)
        two = np.full((len(words), 2), len(sizes) - 1)
        mask = plain.to_numpy(zero_copy_only=False)
        two[mask, 0], two[mask, 1] = heads.indices.to_numpy(), h + tails.indices.to_numpy()
        two[~mask, 0] = h + t + np.arange((~mask).sum())
        return gathered(pool, sizes, two.ravel()), sizes[two].sum(1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (no nulls), one after the other, and how many each has."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = parts.flatten().dictionary_encode()
        pool, sizes = self.distinct(words.dictionary)
        at = words.indices.to_numpy()
        ends = np.r_[0, np.cumsum(sizes[at])]
        bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return gathered(pool, sizes, at), np.diff(ends[bounds])


def gathered(pool: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Entries `at` of pool, which holds entries of these sizes one after the other; some at a time."""
    first, out = np.cumsum(sizes) - sizes, []
    for lo in range(0, len(at), 200_000):
        some = at[lo : lo + 200_000]
        n = sizes[some]
        out.append(pool[np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return np.concatenate([pool[:0], *out])


class Packer:
    """Places one task's documents. put() takes one, close() places what still waits; take() gives placed pieces:
    (document, start, document's tokens, sequence, offset, loss tokens, ids)."""

    def __init__(self, tokens: int, segments: int, loss: int, window: int = WINDOW) -> None:
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be at least 1")
        self.limits, self.window = (tokens, segments, loss), window
        self.waiting: list[tuple[object, int, np.ndarray, int]] = []
        # Tokens and loss-bearing tokens of what waits, in its order.
        self.length, self.bears = np.zeros(window + 1, np.int64), np.zeros(window + 1, np.int64)
        self.placed: list[tuple] = []
        self.next = 0
        self.open()

    def open(self) -> None:
        self.number, self.next = self.next, self.next + 1
        self.room, self.offset = list(self.limits), 0

    def wait(self, k: int, doc: object, at: int, ids: np.ndarray, loss_from: int) -> None:
        """A piece at place k of those that wait."""
        self.waiting[k : k + 1] = [(doc, at, ids, loss_from)]
        self.length[k], self.bears[k] = len(ids) - at, max(0, len(ids) - max(at, loss_from))

    def put(self, doc: object, ids: np.ndarray, loss_from: int = 0) -> None:
        """ids of a document; those before loss_from bear no loss (a prompt)."""
        tokens, _, loss = self.limits
        at = 0
        while loss >= tokens and len(ids) - at >= tokens:  # full sequences need no search
            self.placed.append((doc, at, len(ids), self.next, 0, min(tokens, max(0, at + tokens - loss_from)), ids[at : at + tokens]))
            self.next, at = self.next + 1, at + tokens
        if at < len(ids):
            self.wait(len(self.waiting), doc, at, ids, loss_from)
        while len(self.waiting) > self.window:
            self.place()

    def place(self) -> None:
        n = len(self.waiting)
        length, bears = self.length[:n], self.bears[:n]
        t, s, b = self.room
        lt, ls, lb = self.limits
        # The segment's share is the same for every piece; it counts in the product all the same.
        score = length * (t / lt / lt) + bears * (b / lb / lb) + s / ls / ls
        fits = (length <= t) & (bears <= b)
        k = int(np.argmax(np.where(fits, score, -1.0) if fits.any() else score))
        doc, at, ids, f = self.waiting[k]
        n = min(len(ids) - at, t, max(0, f - at) + b) if s else 0
        if n < 1:
            self.open()
            return
        got = min(n, max(0, at + n - f))
        self.placed.append((doc, at, len(ids), self.number, self.offset, got, ids[at : at + n]))
        self.room, self.offset = [t - n, s - 1, b - got], self.offset + n
        if at + n < len(ids):
            self.wait(k, doc, at + n, ids, f)
        else:
            last = len(self.waiting) - 1
            self.waiting[k], self.length[k], self.bears[k] = self.waiting[last], self.length[last], self.bears[last]
            self.waiting.pop()
        if not self.room[0] or not self.room[1]:
            self.open()

    def close(self) -> None:
        while self.waiting:
            self.place()

    def take(self) -> list[tuple]:
        out, self.placed = self.placed, []
        return out


def pack(
    docs: DataFrame, tokenizer: str, tokens: int = 4096, segments: int = 1024, loss: int | None = None,
    end_id: int = 2, prompt: str | None = None, key: str = "doc_id", window: int = WINDOW, batch_bytes: int = BATCH,
) -> DataFrame:
    """Pieces of all documents (key, text): each token lies in one piece; start counts from the document's start.

    tokenizer is the path of a tokenizers file on every machine. tokens, segments and loss limit a sequence; loss is
    the tokens' limit unless given. prompt names a column of text that stands before text and bears no loss (null:
    none); end_id ends each document and bears loss. ids holds a piece's ids as little-endian unsigned 32-bit numbers.
    sequence_id has the task's number above bit 33. Null and empty texts are the end id alone; repeated rows are
    packed as often as they occur; the key may have any type and be null; other columns are ignored; an empty table
    gives no pieces. A task holds the ids of about batch_bytes of text, which do not
    change the result, or of one longer text, and the waiting pieces.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), text("text").alias("text"), (text(prompt) if prompt else F.lit("")).alias("prompt"))
    schema = PIECES.replace("doc_id long", f"`{key}` {docs.schema[key].dataType.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        tok, packer = WordTokenizer(tokenizer), Packer(tokens, segments, loss or tokens, window)
        end, kind = np.array([end_id], np.uint32), pa.null()

        def batch() -> pa.RecordBatch:
            got = packer.take()
            doc, at, n, seq, off, bears, ids = zip(*got, strict=True) if got else ([],) * 7
            numbers = [pa.array(x, pa.int64()) for x in (at, n, [base + x for x in seq], off, bears)]
            data, sizes = np.concatenate([end[:0], *ids]), np.array([len(x) for x in ids], np.int64)
            ids = pa.Array.from_buffers(pa.binary(), len(got), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes * 4)].astype(np.int32)), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([pa.array(doc, kind), *numbers, ids], names=[key, "start", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"])

        for b in slices(batches, batch_bytes, "text", "prompt"):
            kind = b.column("key").type
            ids, sizes = tok.ids(b.column("text"))
            lead, leads = tok.ids(b.column("prompt")) if prompt else (end[:0], np.zeros(len(b), np.int64))
            at, from_ = np.r_[0, np.cumsum(sizes)].tolist(), np.r_[0, np.cumsum(leads)].tolist()
            for i, doc in enumerate(b.column("key").to_pylist()):
                packer.put(doc, np.concatenate([lead[from_[i] : from_[i + 1]], ids[at[i] : at[i + 1]], end]), from_[i + 1] - from_[i])
            yield batch()
        packer.close()
        if packer.placed:
            yield batch()

    return mapped(rows, run, schema)
