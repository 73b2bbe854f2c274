"""Collocation relations on hand-made trees."""

import pytest
from pyspark.sql import functions as F

from lexispark.functions import sentences as sx
from lexispark.operators import annotate, relations
from lexispark.sources import conllu

SAMPLE = """# newdoc id = http://example.org/rede
# entities = [["ORG", 13, 14]]
# gdex = 0.884521484375
1	Ich	ich	PRON	PPER	Case=Nom|Number=Sing|Person=1|PronType=Prs	2	nsubj	_	_
2	freue	freuen	VERB	VVFIN	Mood=Ind|VerbForm=Fin	0	root	_	_
3	mich	ich	PRON	PRF	Case=Acc|Reflex=Yes	2	expl:pv	_	_
4	sehr	sehr	ADV	ADV	Degree=Pos	2	advmod	_	_
5	über	über	ADP	APPR	AdpType=Prep|Case=Acc	8	case	_	_
6	den	die	DET	ART	Case=Acc	8	det	_	_
7	warmherzigen	warmherzig	ADJ	ADJA	Case=Acc|Degree=Pos	8	amod	_	_
8	Empfang	Empfang	NOUN	NN	Gender=Masc|Number=Sing	2	obl	_	SpaceAfter=No
9	,	,	PUNCT	$,	PunctType=Comm	15	punct	_	_
10	den	die	PRON	PRELS	Case=Acc	15	obj	_	_
11	mir	ich	PRON	PPER	Case=Dat	15	obl:arg	_	_
12	die	die	DET	ART	Case=Nom	13	det	_	_
13	Dokkyo	Dokkyo	NOUN	NN	_	15	nsubj	_	_
14	Universität	Universität	NOUN	NN	Gender=Fem|Number=Sing	13	appos	_	_
15	bereitet	bereiten	VERB	VVFIN	Mood=Ind|VerbForm=Fin	8	acl	_	SpaceAfter=No
16	.	.	PUNCT	$.	PunctType=Peri	2	punct	_	_

"""

# name: tokens "form lemma upos head deprel [case] [verb form]", expected relations
TREES = {
    "copula": (["Tag Tag NOUN 3 nsubj", "ist sein AUX 3 cop", "schön schön ADJ 0 root"], [("PREDC", 1, 3)]),
    "active": (["Tag Tag NOUN 2 nsubj", "beginnt beginnen VERB 0 root"], [("SUBJA", 2, 1)]),
    "passive": (["Haus Haus NOUN 3 nsubj:pass", "wird werden AUX 3 aux:pass", "gebaut bauen VERB 0 root"], [("SUBJP", 3, 1)]),
    "passive by another verb": (["Haus Haus NOUN 3 nsubj:pass", "ist sein AUX 3 aux:pass", "gebaut bauen VERB 0 root"], []),
    "object": (["sieht sehen VERB 0 root", "Haus Haus NOUN 1 obj Acc"], [("OBJ", 1, 2)]),
    "dative object": (["hilft helfen VERB 0 root", "Frau Frau NOUN 1 obj Dat"], [("OBJO", 1, 2)]),
    "dative child": (["hilft helfen VERB 0 root", "der die DET 3 det Dat", "Frau Frau NOUN 1 obj"], [("OBJO", 1, 3)]),
    "accusative wins": (["sieht sehen VERB 0 root", "der die DET 3 det Gen", "Frau Frau NOUN 1 obj Acc"], [("OBJ", 1, 3)]),
    "oblique": (["gedenkt gedenken VERB 0 root", "Toten Tote NOUN 1 obl:arg Gen"], [("OBJO", 1, 2)]),
    "genitive": (["Haus Haus NOUN 0 root", "des die DET 3 det Gen", "Mannes Mann NOUN 1 nmod Gen"], [("GMOD", 1, 3)]),
    "genitive without a sign": (["Haus Haus NOUN 0 root", "Mannes Mann NOUN 1 nmod Gen"], []),
    "genitive with a preposition": (["Haus Haus NOUN 0 root", "wegen wegen ADP 4 case", "des die DET 4 det Gen", "Mannes Mann NOUN 1 nmod Gen"], [("PP", 1, 4, 2)]),
    "coordination": (["Haus Haus NOUN 0 root", "und und CCONJ 3 cc", "Hof Hof NOUN 1 conj"], [("KON", 1, 3)]),
    "comparison": (["stark stark ADJ 0 root", "wie wie CCONJ 3 case", "Bär Bär NOUN 1 obl"], [("KOM", 1, 3)]),
    "comparison by als": (["stärker stark ADJ 0 root", "als als CCONJ 3 case", "Bär Bär NOUN 1 obl"], []),
    "als with a noun": (["dient dienen VERB 0 root", "als als ADP 3 case", "Haus Haus NOUN 1 obl"], [("PP", 1, 3, 2), ("PRED", 3, 1)]),
    "als after mehr": (["dient dienen VERB 0 root", "mehr mehr ADV 1 advmod", "als als CCONJ 4 case", "Haus Haus NOUN 1 obl"], [("ADV", 1, 2)]),
    "für": (["hält halten VERB 0 root", "für für ADP 3 case", "klug klug ADJ 1 xcomp"], [("PRED", 3, 1)]),
    "wie": (["wirkt wirken VERB 0 root", "wie wie SCONJ 3 mark", "neu neu ADJ 1 advcl"], [("PRED", 3, 1)]),
    "bare adjective": (["sieht aussehen VERB 0 root", "gut gut ADJ 1 advcl"], [("PRED", 2, 1)]),
    "bleiben": (["Haus Haus NOUN 2 nsubj", "bleibt bleiben VERB 0 root", "leer leer ADJ 2 xcomp"], [("SUBJA", 2, 1), ("PREDC", 3, 1)]),
    "bleiben with two subjects": (
        ["Haus Haus NOUN 2 nsubj", "bleibt bleiben VERB 0 root", "leer leer ADJ 2 xcomp", "Hof Hof NOUN 2 nsubj"],
        [("SUBJA", 2, 1), ("SUBJA", 2, 4)],
    ),
    "a comparative ends the search": (
        ["befindet befinden VERB 0 root", "mehr mehr ADV 1 advmod", "für für ADP 4 case", "Haus Haus NOUN 1 obl"],
        [("ADV", 1, 2), ("PP", 1, 4, 3)],
    ),
    "a full verb with an auxiliary": (["wirkt wirken VERB 0 root", "wie wie SCONJ 4 mark", "ist sein AUX 4 aux", "gemacht machen VERB 1 advcl - Part"], []),
}


def long_view(sents):
    t = sents.select("key", F.explode("tokens").alias("t"))
    return t.select("key", "t.id", "t.form", "t.lemma", "t.upos", "t.head", "t.deprel", sx.feat(F.col("t"), "Case").alias("case"), sx.feat(F.col("t"), "VerbForm").alias("verb_form"))


def test_sample_sentence(spark):
    sents = conllu.parse(spark.createDataFrame([("s", 0, SAMPLE)], "key string, pos int, block string"), "key")
    got = relations.collocations(long_view(sents), "key").select("rel", "n1", "n2", "n3").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("ADV", 2, 4, None), ("PP", 2, 8, 5), ("ATTR", 8, 7, None), ("SUBJA", 15, 13, None)], key=str)


def test_serialize_parse_round_trip(spark):
    sents = conllu.parse(spark.createDataFrame([("s", 0, SAMPLE)], "key string, pos int, block string"), "key")
    text = sents.select(conllu.serialize(F.col("meta"), F.col("tokens")).alias("x")).first()["x"]
    assert text == SAMPLE


def test_hand_made_trees(spark):
    rows = []
    for name, (tokens, _) in TREES.items():
        for i, t in enumerate(tokens, 1):
            form, lemma, upos, head, rel, *more = t.split()
            case, verb_form = [*(None if x == "-" else x for x in more), None, None][:2]
            rows.append((name, i, form, lemma, upos, int(head), rel, case, verb_form))
    t = spark.createDataFrame(rows, "key string, id int, form string, lemma string, upos string, head int, deprel string, case string, verb_form string")
    got = {}
    for r in relations.collocations(t, "key").collect():
        got.setdefault(r["key"], []).append(tuple(x for x in (r["rel"], r["n1"], r["n2"], r["n3"]) if x is not None))
    for name, (_, expected) in TREES.items():
        assert sorted(got.get(name, [])) == sorted(expected), name


def test_phrasal_verb(spark):
    rows = [("s", 1, "gibt", "geben", "VERB", 0, "root"), ("s", 2, "auf", "auf", "ADP", 1, "compound:prt"), ("s", 3, "recht", "recht", "ADJ", 1, "compound:prt")]
    t = spark.createDataFrame(rows, "key string, id int, form string, lemma string, upos string, head int, deprel string")
    assert [tuple(r) for r in annotate.phrasal_verbs(t, "key").collect()] == [("s", 1, 2, "auf", "aufgeben")]


def test_hit_collocs_and_marks(spark):
    sents = conllu.parse(spark.createDataFrame([("s", 0, SAMPLE)], "key string, pos int, block string"), "key")
    hits = F.array(F.lit(2))
    cols = sx.parse_collocations(F.lit('[["ADV",2,4],["PP",2,8,5],["ATTR",8,7]]'))
    row = sents.select(sx.hit_collocs(cols, hits).alias("h"), sx.marked_text(F.col("tokens"), hits, F.array(F.lit(2), F.lit(4))).alias("m"), sx.collocations_json(cols).alias("j")).first()
    assert [tuple(x) for x in row["h"]] == [("ADV", 4), ("PP", 8)]
    assert row["m"].startswith("Ich <t>freue</t> mich <c>sehr</c> über den") and row["m"].endswith("bereitet.")
    assert row["j"] == '[["ADV", 2, 4], ["PP", 2, 8, 5], ["ATTR", 8, 7]]'


@pytest.mark.parametrize("empty", [True])
def test_no_tokens(spark, empty):
    t = spark.createDataFrame([], "key string, id int, form string, lemma string, upos string, head int, deprel string, case string, verb_form string")
    assert relations.collocations(t, "key").count() == 0
