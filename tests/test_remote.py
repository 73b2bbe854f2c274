"""The remote sources against servers of our own: paging, limits, failures, and what rows are made of hits."""

import http.server
import json
import socketserver
import struct
import threading
import urllib.parse

import pytest

from lexispark.sources import remote

TOKENS = [[0, "Das", "die", "ART", "0", "", ""], [1, "Haus", "Haus", "NN", "1", "Hauss", ""], [0, "", "", "X", "", "", "n"]]


def hit(i):
    meta = {"collection": "c", "basename": f"b{i}", "bibl": "B", "date_": "1999-02-03", "textClass": "x: b:a", "indices_": ["w", "l", "p", "ws", "u", "v"]}
    return {"meta_": meta, "ctx_": [[], TOKENS, []]}


class Socket(socketserver.BaseRequestHandler):
    def handle(self):
        n = struct.unpack("<I", self.request.recv(4))[0]
        command = self.request.recv(n).decode().split("\x01")
        offset, limit, _ = map(int, command[-1].split())
        answer = json.dumps({"nhits_": 7, "hits_": [hit(i) for i in range(7)][offset : offset + limit]}).encode()
        self.request.sendall(struct.pack("<I", len(answer)) + answer)


class Rest(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_GET(self):
        q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query))
        self.seen.append((q, self.headers.get("Authorization")))
        if self.path.startswith("/catalog"):
            body = json.dumps([{"corpus": "c", "host": "h", "port": "7"}])
        elif q.get("q") == "broken":
            body = "{"
        else:
            # A service may give fewer matches than were asked for.
            some = range(int(q["offset"]), min(5, int(q["offset"]) + 2))
            match = {"title": "T.", "author": "A", "corpusTitle": "C", "pubPlace": "P", "pubDate": "2001-05-06", "textClass": "t u", "textType": "k", "snippet": "Ein <mark>Wort</mark> hier."}
            body = json.dumps({"matches": [{**match, "textSigle": f"s{i}"} for i in some], "meta": {"totalResults": 5}})
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body.encode())

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def servers():
    running = [socketserver.ThreadingTCPServer(("127.0.0.1", 0), Socket), http.server.ThreadingHTTPServer(("127.0.0.1", 0), Rest)]
    for s in running:
        threading.Thread(target=s.serve_forever, daemon=True).start()
    yield [s.server_address[1] for s in running]
    for s in running:
        s.shutdown()
        s.server_close()


def test_socket_pages(servers):
    options = {"collections": "c", "endpoints": json.dumps({"c": f"127.0.0.1:{servers[0]}"}), "query": "q", "page": "3"}
    rows = list(remote.SocketReader(options).read(remote.Part("c")))
    assert [r[1] for r in rows] == [f"urn:ddc:c/b{i}" for i in range(7)]
    row = dict(zip([c.split()[0] for c in remote.SCHEMA.split(", ")], rows[0], strict=True))
    assert row["forms"] == ["Das", "Haus", "---"] and row["spaces"] == [True, False, False] and row["hits"] == [2]
    assert row["originals"] == [None, "Hauss", None] and row["norms"] == [None, None, "n"]
    assert (row["date"], row["year"], row["text_classes"]) == ("1999-02-03", 1999, ["a", "b", "x"])
    assert len(list(remote.SocketReader({**options, "limit": "4"}).read(remote.Part("c")))) == 4


def test_socket_source(spark, servers):
    spark.dataSource.register(remote.SocketCorpus)
    options = {"collections": "c", "endpoints": json.dumps({"c": f"127.0.0.1:{servers[0]}"}), "query": "q"}
    assert spark.read.format("socketcorpus").options(**options).load().count() == 7


def test_rest_pages(servers):
    Rest.seen.clear()
    options = {"url": f"http://127.0.0.1:{servers[1]}/", "query": "q", "collection": "k", "interval": "0", "token": "x"}
    rows = list(remote.RestReader(options).read(remote.Part("k")))
    assert [r[1] for r in rows] == [f"urn:korap:k/s{i}" for i in range(5)]
    row = dict(zip([c.split()[0] for c in remote.SCHEMA.split(", ")], rows[0], strict=True))
    assert row["bibl"] == "A: T. C. P. 06.05.2001" and row["topics"] == ["t", "u"] and row["text_classes"] == ["k"]
    assert row["forms"] == ["Ein", "Wort", "hier", "."] and row["hits"] == [2]
    assert [q["offset"] for q, _ in Rest.seen] == ["0", "2", "4"] and all(a == "Bearer x" and q["show-snippet"] == "true" for q, a in Rest.seen)


def test_failures(servers, caplog):
    options = {"url": f"http://127.0.0.1:{servers[1]}/", "query": "broken", "interval": "0"}
    assert list(remote.RestReader(options).read(remote.Part("k"))) == [] and "incomplete" in caplog.text
    with pytest.raises(ValueError):
        list(remote.RestReader({**options, "failOnError": "true"}).read(remote.Part("k")))
    with pytest.raises(OSError):
        list(remote.SocketReader({"endpoints": json.dumps({"c": "127.0.0.1:1"}), "query": "q", "failOnError": "true"}).read(remote.Part("c")))


def test_catalog(servers):
    Rest.seen.clear()
    found = remote.catalog(f"http://127.0.0.1:{servers[1]}/catalog", user="u", password="p")
    assert remote.endpoints(found) == {"c": "h:7"} and Rest.seen[0][1] == "Basic dTpw"


def test_shown_dates():
    assert [remote.shown_date(x) for x in ("2001-05-06", "2001-05", "1999", "x", None)] == ["06.05.2001", "2001", "1999", None, None]
