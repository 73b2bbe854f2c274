"""Readers on small authored inputs."""

import gzip

from pyspark.sql import functions as F

from lexispark.operators import dedupe, index, search, segment
from lexispark.sources import conllu, corpora, remote, speech, tabs, tei

TEI = """<teiCorpus xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><sourceDesc><bibl>Outer.</bibl></sourceDesc></fileDesc></teiHeader>
<TEI><teiHeader><fileDesc><sourceDesc n="ddc" id="orig"><biblFull><publicationStmt><date type="first">2020-05-01</date><ptr type="URL" target="http://x"/></publicationStmt></biblFull>
<bibl>Inner  bibl</bibl></sourceDesc></fileDesc><profileDesc><textClass><keywords><term>b</term><term>a</term></keywords></textClass></profileDesc></teiHeader>
<text><body><p>One<lb/>two<lb break="no"/>three <hi>four</hi> five</p> tail <list><item><p>nested</p></item></list><p> </p></body></text></TEI>
<TEI><text><body><p>Second</p></body></text></TEI></teiCorpus>"""
TABS = """%%$DDC:meta.basename=b1
%%$DDC:meta.date_=1999
%%$DDC:index[0]=Token w
%%$DDC:index[1]=Lemma l
%%$DDC:index[2]=Pos p
%%$DDC:index[3]=WS ws
Der\tder\tART\t0
Hund\tHund\tNN\t1

.\t.\t$.\t0

<b>\t<b>\tXY\t1
"""


def test_tei():
    rows = tei.documents("c", "a b/x.xml", TEI.encode())
    assert [(r["doc_id"], r["par_no"], r["text"]) for r in rows] == [
        ("urn:corpus:c:a%20b/x.xml", 1, "One twothree four five"), ("urn:corpus:c:a%20b/x.xml", 2, "nested"), ("urn:corpus:c:a%20b/x.xml/d2", 1, "Second"),
    ]
    assert (rows[0]["bibl"], rows[0]["date"], rows[0]["year"], rows[0]["url"], rows[0]["text_classes"]) == ("Inner bibl", "2020-05-01", 2020, "http://x", ["a", "b"])
    assert rows[2]["bibl"] == "Outer." and tei.documents("c", "p", b"<broken") == []


def test_tei_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.xml").write_text(TEI)
    rows = tei.read(spark, str(tmp_path), "c").collect()
    assert len(rows) == 3 and rows[0]["doc_id"] == "urn:corpus:c:d/x.xml"


def test_tabs(spark):
    got = tabs.parse(spark.createDataFrame([("f", TABS)], "file string, text string")).orderBy("pos").collect()
    assert [[(t["form"], t["lemma"], t["space"]) for t in r["tokens"]] for r in got] == [
        [("Der", "der", True), ("Hund", "Hund", False)], [(".", ".", True)], [("<b>", "<b>", True)],
    ]
    assert got[0]["meta"] == {"newdoc id": "b1", "date": "1999"}
    rows = tabs.parse(spark.createDataFrame([("f", TABS)], "file string, text string"))
    clean = tabs.without_fragments(rows, F.array_join("tokens.form", " "))
    assert clean.count() == 2


def test_conllu_files(spark, tmp_path):
    text = "# newdoc id = d1\n# newpar id = p1\n1\ta\t_\t_\t_\t_\t_\t_\t_\t_\n\n1\tb\t_\t_\t_\t_\t_\t_\t_\t_\n\n# newdoc id = d2\n1\tc\t_\t_\t_\t_\t_\t_\t_\t_\n\n"
    with gzip.open(tmp_path / "x.conll.gz", "wt") as f:
        f.write(text)
    got = conllu.with_documents(conllu.read(spark, str(tmp_path)), "file").orderBy("pos").collect()
    assert [(r["doc_id"], r["sent_no"], r["par_no"], r["tokens"][0]["form"]) for r in got] == [("d1", 1, 1, "a"), ("d1", 2, 1, "b"), ("d2", 1, None, "c")]
    conllu.write(conllu.read(spark, str(tmp_path)), str(tmp_path / "out"))
    assert conllu.read(spark, str(tmp_path / "out")).count() == 3


def test_remote_rows():
    assert remote.parse_snippet("a <mark>b c</mark> d &amp; e") == ("a b c d & e", [(2, 5)])
    row = remote.match_row("k", {"textSigle": "A/B", "pubDate": "2001-02-03", "snippet": "x <mark>yy</mark>.", "title": "T?", "author": "Z"})
    assert row[1] == "urn:korap:k/A/B" and row[13] == [2] and row[2] == "Z: T? 03.02.2001"
    hit = {"meta_": {"indices_": ["w", "l", "p", "ws"], "collection": "c", "basename": "n", "date_": "1999"}, "ctx_": [[], [[1, "Ein", "ein", "ART", "1"], [0, "Tag", "Tag", "NN", "1"]], []]}
    row = remote.hit_row(hit)
    assert row[1] == "urn:ddc:c/n" and row[3] is None and row[4] == 1999 and row[12] == [True, False] and row[13] == [1]
    assert remote.socket_query_words(["o'x"]) == "('o\\'x' || '@o\\'x')" and remote.rest_query_words(["a b"]) == "(&ab or ab)"


def test_failed_source_is_empty(spark):
    spark.dataSource.register(remote.SocketCorpus)
    rows = spark.read.format("socketcorpus").options(collections="c", endpoints='{"c": "127.0.0.1:1"}', query="x", timeout="1").load()
    assert rows.count() == 0


def test_speech(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<c><text person="P" titel="T" datum="2001" url="u"><rohtext>a  b</rohtext></text></c>')
    assert tuple(speech.read(spark, str(tmp_path)).first()) == ("u", "P. T. 2001. o.O.", "2001", "a b")


def test_manifest(spark, tmp_path):
    for d in ("k/xml-2020", "k/xml-2021", "legacy/xml", "d/2020-01-01"):
        (tmp_path / d).mkdir(parents=True)
    (tmp_path / "k/xml-2021/a.xml").write_text("<a/>")
    found = corpora.discover(spark, str(tmp_path))
    assert {k: v.rpartition("/")[2] for k, v in found.items()} == {"k": "xml-2021", "d": "2020-01-01"}
    files = corpora.sources(spark, "k", found["k"])
    empty = spark.createDataFrame([], "corpus string, path string, digest string, imported long, import_path string")
    new = corpora.next_manifest(files, empty, 5, "b")
    assert new.count() == 1 and corpora.changed(files, new).count() == 0 and corpora.unchanged(files, new).count() == 1


def test_greedy_keep(spark):
    words = "a b c d e f g h i j k l m n o p".split()
    rows = [(0, words), (1, words), (2, []), (3, []), (4, ["x", "y"])]
    prints = spark.createDataFrame(rows, "ord int, lemmas array<string>")
    got = dict(map(tuple, dedupe.greedy_keep(dedupe.bands(prints, "ord"), "ord").collect()))
    assert got == {0: True, 1: False, 2: True, 3: False, 4: True}
    chain = [(0, 0, 1), (1, 0, 1), (1, 1, 2), (2, 1, 2)]  # 0-1 and 1-2 collide: 0 and 2 stay
    got = dict(map(tuple, dedupe.greedy_keep(spark.createDataFrame(chain, "ord int, band int, key long"), "ord").collect()))
    assert got == {0: True, 1: False, 2: True}


def test_pre_analyzed(spark):
    t = spark.createDataFrame([("d", 1, "Der", True), ("d", 2, "a=b", False)], "key string, id int, form string, space boolean")
    terms = spark.createDataFrame([("d", 1, "#der")], "key string, id int, term string")
    assert index.pre_analyzed(t, terms, "key").first()["text_pre"] == "1 =Der a\\=b= Der,i=1,s=0,e=3 #der,i=0,s=0,e=3 a\\=b,i=1,s=4,e=7"


def test_repaired_hits(spark):
    row = spark.sql("select array(1, 2, 3, 4) as hits, array(named_struct('form','a','lemma','a'), named_struct('form','b','lemma','b'), named_struct('form','c','lemma','w'), named_struct('form','d','lemma','d')) as t")
    assert row.select(search.repaired_hits(F.col("hits"), F.col("t"), F.array(F.lit("w")))).first()[0] == [1, 3, 4]


def test_segment_edges(spark):
    rows = spark.createDataFrame([(1, "A b. C!\n\nd"), (2, ""), (3, None), (4, "  ")], "doc_id int, text string")
    got = segment.sentences(rows, "doc_id").orderBy("doc_id", "sent_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, "A b."), (1, 2, "C!"), (1, 3, "d")]


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_conllu_evaluates_once(spark):
    """Lines and their fields are made once, whatever is read of them, and the source of blocks is not evaluated for a filter."""
    block = "# a = 1\r\n# a = 2\r\n#b\r\n1\tx\t_\tNOUN\t_\tk=v|k=w|n|=\t0\t\t_\tA=\r\n\r\n1-2\ty\n2\t_\n"
    rows = spark.createDataFrame([(1, block, 0), (2, "\n", 0), (3, None, 0), (4, "#", 0)], "k int, text string, pos int")
    back = conllu.parse(rows.select("k", "pos", F.upper(F.lower("text")).alias("block")), "k")
    assert _plan(back).count("upper(") == 1 and _plan(back).count("split(") <= 9
    back = conllu.parse(rows.withColumnRenamed("text", "block"), "k").orderBy("k").collect()
    assert [(r["k"], r["meta"], len(r["tokens"])) for r in back] == [(1, {"a": "2", "b": ""}, 2), (4, {"": ""}, 0)]
    t = [x.asDict() for x in back[0]["tokens"]]
    assert t[0] == {"id": 1, "form": "x", "lemma": None, "upos": "NOUN", "xpos": None, "feats": {"k": "w", "": ""}, "head": 0, "deprel": "", "deps": None, "misc": {"A": ""}}
    assert t[1] == {"id": 2, "form": "_", **dict.fromkeys(("lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc"))}


def test_tokens_evaluated_once(spark):
    text = "A\tb.  c\u00a0d \u2014 e\n \n\t\n\U0001f600x"
    rows = spark.createDataFrame([(1, text)], "k int, text string")
    got = segment.tokens(segment.sentences(rows, "k"), "k")
    assert _plan(got).count("regexp_extract_all(") == 1 and _plan(got).count("regexp_replace(") == 1
    assert [(r["sent_no"], r["form"], r["space"]) for r in got.orderBy("sent_no", "id").collect()] == [
        (1, "A", True), (1, "b", False), (1, ".", False), (2, "c", False), (2, "\u00a0", False), (2, "d", True), (2, "\u2014", True), (2, "e", False),
        (3, "---", False), (4, "\U0001f600", False), (4, "x", False),
    ]


def test_streams_of_arrays(spark):
    """Long and array form agree, also where running sums are made in blocks; the long form deals its rows once."""
    rows = [("d", i, "w" * (i % 5 + 1), i % 3 > 0) for i in range(1, 301)]
    t = spark.createDataFrame(rows, "key string, id int, form string, space boolean")
    terms = t.where("id % 2 = 0").select("key", "id", F.explode(F.array(F.lit("b"), F.lit("a"), F.lit("b"))).alias("term"))
    out = index.pre_analyzed(t, terms.unionByName(terms.withColumn("id", F.lit(999))), "key")
    want, place = [], 0
    for _, i, form, space in rows:
        want += [f"{x},i={n},s={place},e={place + len(form)}" for n, x in [(1, form), *([(0, "a"), (0, "b")] if i % 2 == 0 else [])]]
        place += len(form) + space
    text = "".join(form + " " * space for _, _, form, space in rows).rstrip(" ")
    assert out.first()["text_pre"] == f"1 ={text}= {' '.join(want)}"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
    xs = t.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("id", "form", "space", F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("terms")))).alias("xs"))
    assert xs.select(index.stream(F.col("xs"))).first()[0] == out.first()["text_pre"]


def test_kept_first(spark, monkeypatch):
    """The same as by signatures in plain Python; sentences of equal words and those that share no bucket go through no round."""
    import hashlib
    import random

    rng, rows = random.Random(5), []
    words = [f"w{i}" for i in range(400)]
    for i in range(300):
        old = rng.choice(rows)[1] if rows and rng.random() < 0.7 else rng.sample(words, rng.choice([1, 3, 40, 120]))
        rows.append((i, old if rng.random() < 0.4 else [*old[:-1], rng.choice(words)]))
    rows += [(300, []), (301, None), (302, [f"x{i % 20000}" for i in range(40000)]), (303, [f"x{i}" for i in range(20000)])]
    h = {w: int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for _, ws in rows for w in ws or []}
    p = dedupe.PRIME
    kept, seen, buckets = set(), set(), []
    for i, ws in rows:
        hs = {h[w] for w in ws or []}
        sig = [min(((x * (48271 * (k + 1) % p) + 69621 * (k + 7) % p) % p for x in hs), default=p) for k in range(128)]
        mine = {(b, *sig[25 * b : 25 * b + 25]) for b in range(5)}
        buckets.append(mine)
        if not mine & seen:
            kept.add(i)
            seen |= mine
    asked, real = [], dedupe.greedy_keep
    monkeypatch.setattr(dedupe, "greedy_keep", lambda banded, order: asked.append(banded.select(order).distinct().count()) or real(banded, order))
    signed = dedupe.signed(spark.createDataFrame(rows, "ord int, lemmas array<string>"), "ord")
    assert {r["ord"] for r in dedupe.kept_first(signed, "ord").collect()} == kept
    firsts = [m for k, m in enumerate(buckets) if m not in buckets[:k]]
    assert asked == [sum(any(m & n for n in firsts if n is not m) for m in firsts)] and 0 < asked[0] < len(firsts) < len(rows)
