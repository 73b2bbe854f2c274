"""Commands from files to files, and the grammar reader."""

import json

from lexispark.__main__ import main
from lexispark.sources import conllu, grammar

from .test_relations import SAMPLE
from .test_sources import TEI

GRAMMAR = """<grammar xmlns="http://relaxng.org/ns/structure/1.0"><start><ref name="doc"/></start>
<define name="doc"><element name="doc"><zeroOrMore><ref name="model.common"/></zeroOrMore><optional><attribute name="n"><text/></attribute></optional></element></define>
<define name="model.common"><choice><ref name="p"/><ref name="eg"/></choice></define>
<define name="model.pLike"><ref name="p"/></define><define name="model.egLike"><ref name="eg"/></define>
<define name="model.milestoneLike"><choice><ref name="lb"/><ref name="p"/></choice></define>
<define name="p"><element name="p"><mixed><ref name="lb"/></mixed></element></define>
<define name="eg"><element name="eg"><text/></element></define><define name="lb"><element name="lb"><empty/></element></define></grammar>"""


def test_grammar():
    got = json.loads(grammar.Grammar(GRAMMAR).to_json())
    assert got == {"containers": ["doc", "lb"], "milestones": ["lb"], "chunks": ["p"], "paras": ["p"]}


def test_annotate_and_index(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.conllu").write_text(SAMPLE)
    main(["annotate", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")])
    row = conllu.read(spark, str(tmp_path / "out")).first()
    assert sorted(json.loads(row["meta"]["collocations"])) == sorted([["ADV", 2, 4], ["PP", 2, 8, 5], ["ATTR", 8, 7], ["SUBJA", 15, 13]])
    main(["index", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "index")])
    record = json.loads(spark.read.text(str(tmp_path / "index")).first()[0])
    assert record["id"] == "http://example.org/rede#1" and record["gdex_b"] is True


def test_convert_twice(spark, tmp_path):
    (tmp_path / "c/k/xml").mkdir(parents=True)
    (tmp_path / "c/k/xml/a.xml").write_text(TEI)
    for _ in range(2):
        main(["convert", "--input", str(tmp_path / "c"), "--output", str(tmp_path / "out")])
    rows = conllu.read(spark, str(tmp_path / "out/sentences"))
    assert rows.count() == 3 and spark.read.parquet(str(tmp_path / "out/manifest")).count() >= 1
