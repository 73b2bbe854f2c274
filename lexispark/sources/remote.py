"""Remote corpora as Python data sources: a line-length socket protocol and a paged REST service.

spark.dataSource.register(SocketCorpus); spark.read.format("socketcorpus").option("endpoint", "host:port")... A request
that fails or times out ends its partition with a logged warning, or fails the job with option failOnError = true. Each
collection is one input partition.
"""

from __future__ import annotations

import base64
import json
import logging
import re
import socket
import struct
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "collection string, doc_id string, bibl string, date string, year int, country string, availability string, "
    "text_classes array<string>, topics array<string>, forms array<string>, lemmas array<string>, tags array<string>, "
    "spaces array<boolean>, hits array<int>, originals array<string>, norms array<string>"
)
log = logging.getLogger(__name__)


def failed(options: dict, what: str, error: Exception) -> None:
    """A request failed: the partition ends here, said aloud, or the error goes on where failOnError asks for it."""
    if str(options.get("failOnError", "false")).lower() == "true":
        raise error
    log.warning("%s: incomplete, a request failed: %s", what, error)


def socket_request(endpoint: tuple[str, int], command: str, timeout: float) -> dict:
    """Four bytes of length, little-endian, before the command and before the JSON answer."""
    with socket.create_connection(endpoint, timeout) as s:
        data = command.encode()
        s.sendall(struct.pack("<I", len(data)) + data)

        def exactly(n: int) -> bytes:
            out = b""
            while len(out) < n:
                part = s.recv(n - len(out))
                if not part:
                    raise ConnectionError("the peer closed early")
                out += part
            return out

        return json.loads(exactly(struct.unpack("<I", exactly(4))[0]))


def socket_query(endpoint: tuple[str, int], q: str, offset: int, limit: int, timeout: int) -> dict:
    return socket_request(endpoint, f"run_query Distributed\x01{q}\x01json\x01{offset} {limit} {timeout}", timeout)


def hit_row(hit: dict) -> tuple:
    """A hit of the socket protocol: names of token fields come with it, the middle context holds the tokens."""
    meta = hit["meta_"]
    names = meta["indices_"]
    tokens = [dict(zip(names, t if isinstance(t, list) else t.get("values", []), strict=True)) for t in (x[1:] if isinstance(x, list) else x for x in hit["ctx_"][1])]
    flags = [x[0] if isinstance(x, list) else 0 for x in hit["ctx_"][1]]
    get = lambda k: [t.get(k) for t in tokens]
    spaces = [i + 1 < len(tokens) and tokens[i + 1].get("ws") == "1" for i in range(len(tokens))]
    day = meta.get("date_") or ""
    classes = sorted(x.strip() for x in (meta.get("textClass") or "").split(":") if x.strip()) or None
    return (
        meta.get("collection"), f"urn:ddc:{meta.get('collection')}/{meta.get('basename')}", meta.get("bibl"), day if re.fullmatch(r"\d{4}-\d\d-\d\d", day) else None,
        int(day[:4]) if re.match(r"\d{4}", day) else None, meta.get("country"), meta.get("avail"), classes, None,
        [w or "---" for w in get("w")], get("l"), get("p"), spaces, [i for i, f in enumerate(flags, 1) if f == 1], [x or None for x in get("u")], [x or None for x in get("v")],
    )


def socket_query_words(words: list[str]) -> str:
    """Every word as lemma or as form."""
    quoted = [re.sub(r"(['\\])", r"\\\1", w) for w in words]
    return " && ".join(f"('{w}' || '@{w}')" for w in quoted)


def rest_query_words(words: list[str]) -> str:
    kept = [re.sub(r'[ ()#,"]', "", w) for w in words]
    return " /s0 ".join(f"(&{w} or {w})" for w in kept)


class Part(InputPartition):
    def __init__(self, collection: str) -> None:
        super().__init__(0)
        self.collection = collection


class SocketReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Part]:
        return [Part(c) for c in self.options["collections"].split(",")]

    def read(self, partition: Part) -> Iterator[tuple]:
        host, port = json.loads(self.options["endpoints"])[partition.collection].split(":")
        page, limit, offset = int(self.options.get("page", 1000)), int(self.options.get("limit", 0)), 0
        try:
            while True:
                got = socket_query((host, int(port)), self.options["query"], offset, min(page, limit - offset) if limit > 0 else page, int(self.options.get("timeout", 5)))
                for hit in got.get("hits_", []):
                    yield hit_row(hit)
                offset += len(got.get("hits_", []))
                if not got.get("hits_") or offset >= got["nhits_"] or 0 < limit <= offset:
                    return
        except (OSError, ValueError) as e:
            failed(self.options, partition.collection, e)


class SocketCorpus(DataSource):
    @classmethod
    def name(cls) -> str:
        return "socketcorpus"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SocketReader:  # noqa: ANN001
        return SocketReader(self.options)


def parse_snippet(snippet: str) -> tuple[str, list[tuple[int, int]]]:
    """Plain text of a snippet and the places of its <mark> elements; other elements are dropped."""
    out, marks, start, at = [], [], None, 0
    for piece in re.split(r"(<[^>]*>)", snippet):
        if piece.startswith("<"):
            if re.match(r"<mark\b", piece):
                start = at if start is None else start
            elif piece.startswith("</mark") and start is not None:
                marks.append((start, at))
                start = None
            continue
        text = re.sub(r"&(amp|lt|gt|quot|#39);", lambda m: {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "#39": "'"}[m[1]], piece)
        out.append(text)
        at += len(text)
    return "".join(out), marks


def shown_date(day: str | None) -> str | None:
    """dd.mm.YYYY of a full date; of anything else its leading year, if it has one."""
    m = re.match(r"(\d{4})(?:-(\d\d)-(\d\d)$)?", day or "")
    return None if not m else ".".join((m[3], m[2], m[1])) if m[2] else m[1]


def bibl(match: dict) -> str | None:
    """author: title. subtitle, corpus, place, date, joined by full stops; a stop after another mark is dropped."""
    norm = lambda x: (x or "").strip() or None
    single = lambda x: re.sub(r"([!,\-./:;?\[\]{}])\.", r"\1", x)
    title = single(". ".join(x for x in (norm(match.get("title")), norm(match.get("subTitle"))) if x))
    lead = ": ".join(x for x in (norm(match.get("author")), title) if x)
    parts = (lead, norm(match.get("corpusTitle")), norm(match.get("pubPlace")), shown_date(match.get("pubDate")))
    return single(". ".join(x for x in parts if x)) or None


def match_row(collection: str, match: dict) -> tuple:
    text, marks = parse_snippet(match.get("snippet") or "")
    tokens = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\W_]+|[^\w\s]|_", text)]
    hits = [i for i, (_, a, b) in enumerate(tokens, 1) if any(x < b and a < y for x, y in marks)]
    day = match.get("pubDate") or ""
    split = lambda k: sorted(x for x in re.split(r"[:\s]", match.get(k) or "") if x) or None
    return (
        collection, f"urn:korap:{collection}/{match.get('textSigle')}", bibl(match), day if re.fullmatch(r"\d{4}-\d\d-\d\d", day) else None,
        int(day[:4]) if re.match(r"\d{4}", day) else None, match.get("pubPlaceKey"), match.get("availability"), split("textType"), split("textClass"),
        [t for t, _, _ in tokens], None, None, [b < len(text) and text[b].isspace() for _, _, b in tokens], hits, None, None,
    )


class RestReader(DataSourceReader):
    """One partition: the service allows a call every `interval` seconds."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Part]:
        return [Part(self.options.get("collection", "rest"))]

    def read(self, partition: Part) -> Iterator[tuple]:
        page, calls, most = int(self.options.get("page", 100)), int(self.options.get("calls", 100)), int(self.options.get("limit", 10_000))
        seen = 0
        for _ in range(calls):
            params = {"q": self.options["query"], "ql": "cosmas2", "count": page, "offset": seen, "fields": "@all", "context": "sentence", "show-snippet": "true"}
            if self.options.get("cq"):
                params["cq"] = self.options["cq"]
            request = urllib.request.Request(f"{self.options['url']}?{urllib.parse.urlencode(params)}")
            if self.options.get("token"):
                request.add_header("Authorization", f"Bearer {self.options['token']}")
            try:
                with urllib.request.urlopen(request, timeout=float(self.options.get("timeout", 30))) as answer:
                    got = json.loads(answer.read())
            except (OSError, ValueError) as e:
                return failed(self.options, partition.collection, e)
            for match in got.get("matches", []):
                yield match_row(partition.collection, match)
                seen += 1
                if seen >= most:
                    return
            if not got.get("matches") or seen >= got["meta"]["totalResults"]:
                return
            time.sleep(float(self.options.get("interval", 2)))


class RestCorpus(DataSource):
    @classmethod
    def name(cls) -> str:
        return "restcorpus"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RestReader:  # noqa: ANN001
        return RestReader(self.options)


def catalog(url: str, timeout: float = 30, user: str | None = None, password: str | None = None) -> list[dict]:
    """Collections that a catalog service lists (JSON), by basic authentication where a user is given."""
    request = urllib.request.Request(url)
    if user:
        request.add_header("Authorization", "Basic " + base64.b64encode(f"{user}:{password or ''}".encode()).decode())
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.loads(answer.read())


def endpoints(entries: list[dict]) -> dict[str, str]:
    """Collection to host:port, as the socket source's option endpoints takes it in JSON."""
    return {e["corpus"]: f"{e['host']}:{int(e['port'])}" for e in entries}
