"""WARC archives and a capture index that is merged from sorted runs.

Each record is a gzip member of its own, so the index's offset and length find it without inflating what stands before.
Spark's text writer writes the members, with an empty gzip member as its line end: its committer, which renames finished
files, also guards against lost executors. Which record revisits which is settled on narrow rows; payloads are not shuffled.

Each archive gives one run of index rows, sorted by URL key, timestamp and record, and the runs are written as a table.
Rows are dealt by ranges of that key, as many as hold RANGE rows each at most on average, and each task merges what its
range has of the runs with a tree of losers. The partitions in order form one globally ordered capture history.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from base64 import b32encode
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, slices

END = "\r\n\r\n"
#: A gzip member without content, as a line end.
EMPTY = gzip.compress(b"", mtime=0)
#: Index rows of a range that a task merges; bytes of records that are compressed together; records of an archive.
RANGE, BATCH, RECORDS = 100_000, 16_000_000, 5000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = (
    "url_key string, timestamp string, page_id long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, url string, archive string, offset long, length long"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits, five hex digits, give four signs."""
    at = lambda i: F.substr(F.sha1(payload), F.lit(i // 4 * 5 + 1), F.lit(5))
    sign = lambda i: F.shiftright(F.conv(at(i), 16, 10).cast("int"), 15 - i % 4 * 5).bitwiseAND(F.lit(31))
    return F.concat(*[F.substr(F.lit(ALPHABET), sign(i) + 1, F.lit(1)) for i in range(32)])


def records(pages: DataFrame) -> DataFrame:
    """(record): a WARC record for each row of pages (page_id, url, html; timestamp, if there is one).

    Of rows with equal payloads the one with the smallest page_id is a response and the others are revisits of it
    (among repeated page_ids any one; a null page_id comes last). A null html is an empty payload; a null url an empty
    one. Other columns are ignored. pages must give the same rows in the same order each time it is read, as files do.
    """
    when = F.col("timestamp") if "timestamp" in pages.columns else F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    rows = pages.select(
        "page_id",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
    ).withColumns({"digest": sha1_base32(F.col("html")), "row": F.monotonically_increasing_id(), "n": F.octet_length("html")})
    of = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("row"))
    scratch = Scratch(pages.sparkSession, "revisits")
    narrow = scratch.keep(rows.select("page_id", "row", "digest"), "digests")
    small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS // 10 else df
    firsts = scratch.keep(narrow.groupBy("digest").agg(F.min(of).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    later = narrow.select("row", "digest").join(small(firsts), "digest").where("row <> first.row")
    later = scratch.keep(later.select("row", F.col("first.page_id").alias("of"), F.lit(True).alias("again")), "later")
    rows = rows.join(small(later), "row", "left")
    first = F.col("again").isNull()
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    block = F.when(first, F.concat(http, F.col("html"))).otherwise(http)
    return rows.select(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), F.when(first, F.lit("response")).otherwise(F.lit("revisit")),
            F.lit("\r\nWARC-Record-ID: "), ident(F.col("page_id")),
            F.when(first, F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Refers-To: "), ident(F.col("of")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Date: "), F.col("at"),
            F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
            F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(END), block, F.lit(END),
        ).alias("record")
    )


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS) -> None:
    """Archives of at most so many records each, below path (names end in .txt: the writer's)."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BATCH, "record"):
            yield pa.RecordBatch.from_arrays([pa.array([gzip.compress(r.encode(), 6, mtime=0) for r in b.column(0).to_pylist()], pa.binary())], names=["member"])

    packed = records(pages).mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("member"))
    writer = packed.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).option("compression", "none")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def url_key(url: str) -> str:
    """Sort key: host labels from the right, then the rest, in lower case."""
    _, sep, rest = url.lower().partition("://")
    host, tail = re.match(r"([^/?#]*)(.*)", rest if sep else url.lower(), re.S).groups()
    return ",".join(reversed(host.split("."))) + ")" + (tail or "/")


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member that has content; what is read ahead of a member's end is bounded."""
    at, view = 0, memoryview(data)
    while at < len(data):
        inflate, out, end = zlib.decompressobj(31), [], at
        while not inflate.eof:
            if end >= len(data):
                raise ValueError(f"the member at byte {at} does not end")
            out.append(inflate.decompress(view[end : end + 65536]))
            end = min(end + 65536, len(data))
        end -= len(inflate.unused_data)
        content = b"".join(out)
        if content:
            yield at, end - at, content
        at = end


def parse(archive: str, data: bytes) -> Iterator[tuple]:
    """Index rows of one archive, in its order; what a record says of its payload is checked against the payload."""
    for at, size_there, record in members(data):
        head_end = record.index(b"\r\n\r\n")
        head = dict(line.split(": ", 1) for line in record[:head_end].decode().split("\r\n")[1:])
        start, n = head_end + 4, int(head["Content-Length"])
        block = record[start : start + n]
        if record[start + n :] != b"\r\n\r\n":
            raise ValueError(f"{archive}: the record at byte {at} does not end where it says")
        http_end = block.index(b"\r\n\r\n") + 4
        size = int(re.search(rb"\r\nContent-Length: (\d+)", block[:http_end])[1])
        digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
        if kind == "response" and (b32encode(hashlib.sha1(block[http_end:]).digest()).decode() != digest or len(block) - http_end != size):
            raise ValueError(f"{archive}: the payload at byte {at} is not what its header says")
        of = lambda k: None if (x := head.get(k, "").removeprefix("<urn:page:").removesuffix(">")) in ("", "none") else int(x)
        yield (url_key(head["WARC-Target-URI"]), head["WARC-Date"], of("WARC-Record-ID"), kind, size, digest, of("WARC-Refers-To"), head["WARC-Target-URI"], archive, at, size_there)


def order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is None, row[2] or 0, row[8], row[9]


def arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


ARROW = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in INDEX.split(", "))]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of all archives below path; each archive is one sorted run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column("path"), b.column("content"), strict=True):
                rows = sorted(parse(name.as_py(), data.as_py()), key=order)
                for lo in range(0, len(rows), 5000):
                    yield arrow(rows[lo : lo + 5000], ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX)


def merge(runs: list[Iterable]) -> Iterator[tuple]:
    """k-way merge of sorted (key, row) runs by a tree of losers: a row costs one comparison a level."""
    its = [iter(r) for r in runs]
    k = len(its)
    if not k:
        return
    done = object()
    heads = [next(i, done) for i in its]

    def less(a: int, b: int) -> bool:
        if heads[a] is done or heads[b] is done:
            return heads[b] is done and heads[a] is not done
        return heads[a][0] < heads[b][0]

    # Leaves k..2k-1 are the runs; node i keeps the loser of its two sides, node 0 the winner of all.
    tree, win = [0] * k, [0] * (2 * k)
    for i in range(2 * k - 1, 0, -1):
        if i >= k:
            win[i] = i - k
        else:
            a, b = win[2 * i], win[2 * i + 1]
            win[i], tree[i] = (b, a) if less(b, a) else (a, b)
    winner = win[1] if k > 1 else 0
    while heads[winner] is not done:
        yield heads[winner][1]
        heads[winner] = next(its[winner], done)
        i = (winner + k) // 2
        while i:
            if less(tree[i], winner):
                tree[i], winner = winner, tree[i]
            i //= 2


def merged_index(index: DataFrame, n: int | None = None) -> DataFrame:
    """The runs of index in global order: partitions by ranges of (url_key, timestamp, page_id, archive), each merged.

    A URL captured very often is cut by its timestamps and records. A task holds the index rows of its range, RANGE on
    average; n sets the number of ranges instead. The partition's number and the place in it are columns part and place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        runs: list[list[tuple]] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key = order(row)
                if runs and runs[-1][-1][1][8] == row[8] and runs[-1][-1][0] <= key:
                    runs[-1].append((key, row))
                else:
                    runs.append([(key, row)])
        part, out, place = TaskContext.get().partitionId(), [], 0
        for row in merge(runs):
            out.append((*row, part, place))
            place += 1
            if len(out) == 5000:
                yield arrow(out, merged)
                out = []
        yield arrow(out, merged)

    merged = pa.schema([*ARROW, ("part", pa.int64()), ("place", pa.int64())])
    n = n or max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-index.count() // RANGE))
    dealt = index.repartitionByRange(n, "url_key", "timestamp", "page_id", "archive")
    return dealt.mapInArrow(run, INDEX + ", part long, place long")


def captures(pages: DataFrame, path: str) -> DataFrame:
    """Writes pages to archives below path, reads them back and gives the merged capture index.

    One row per row of pages, repeated rows and empty payloads included; an empty table gives none.
    """
    write_archives(pages, path)
    return merged_index(Scratch(pages.sparkSession, "runs").keep(read_archives(pages.sparkSession, path)))
