"""Collocation relations over dependency trees in the long view.

tokens: (keys, id, form, lemma, upos, head, deprel, case, verb_form), case and verb_form null where a token has none.
Rows are a bag: a relation found twice is given twice.

All that a relation needs lies in one sentence, so tokens are dealt by sentence once. What relations ask of a token's
children is a word of bits, gathered by head; then a sentence is one array, in which a token finds its head, and that
one its own head, by their numbers. Neither step needs another exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relation, dependency relations and parts of speech of the patterns with a head, and with two heads.
PATTERNS2 = [
    ("ADV", "advmod", "VERB", "ADV"),
    ("ADV", "advmod", "ADJ", "ADV"),
    ("ADV", "advmod", "VERB", "ADJ"),
    ("ADV", "advmod", "ADJ", "ADJ"),
    ("ATTR", "amod", "NOUN", "ADJ"),
]
PATTERNS3 = [
    ("KON", "conj", "cc", "NOUN", "NOUN", "CCONJ"),
    ("KON", "conj", "cc", "VERB", "VERB", "CCONJ"),
    ("KON", "conj", "cc", "ADJ", "ADJ", "CCONJ"),
    ("PP", "nmod", "case", "NOUN", "NOUN", "ADP"),
    ("PP", "obl", "case", "VERB", "NOUN", "ADP"),
    ("PP", "obl", "case", "VERB", "ADJ", "ADP"),
    ("PP", "obl", "case", "VERB", "ADV", "ADP"),
    ("PP", "obj", "case", "VERB", "NOUN", "ADP"),
]
# Verbs with a predicative after für, als with an adjective, als with a noun, wie.
VERBS_FUER = "befinden halten".split()
VERBS_ALS_ADJ = """annehmen ansehen ausgeben befinden bezeichnen empfehlen erfahren erkennen erklären erleben erscheinen
fürchten kennen kennenlernen kritisieren missverstehen nehmen rechnen verkaufen wirken zeichnen zählen""".split()
VERBS_ALS_NOUN = """ablehnen anfangen beginnen behalten behandeln benutzen bestimmen bestätigen bewerben buchstabieren
dienen drucken eignen einsetzen enden entdecken erhalten finden funktionieren fühlen gebrauchen gehen gewinnen haben
handeln kandidieren laufen lesen malen meinen nennen nutzen organisieren planen sehen tragen verbringen verstehen
verwenden vorkommen vorschlagen vorstellen wirken wählen zeichnen zählen überraschen""".split()
VERBS_WIE = """aussehen behandeln bleiben erscheinen fühlen gebrauchen malen organisieren vorkommen vorstellen wirken""".split()
RELATIONS = ["ADV", "ATTR", "PP", "KON", "KOM", "GMOD", "SUBJA", "SUBJP", "OBJ", "OBJO", "PREDC", "PRED"]


def facts() -> dict[str, Column]:
    """What a token may be to its head; a head's c_* column says whether any child is."""
    rel, lemma = F.col("deprel"), F.col("lemma_text")
    return {
        "c_case": rel == "case",
        "c_cop": rel == "cop",
        "c_copula": (rel == "cop") & lemma.isin("werden", "sein", "bleiben"),
        "c_gen": F.col("case") == "Gen",
        "c_oblique": (rel != "nmod") & F.col("case").isin("Gen", "Dat"),
        "c_passive": (rel == "aux:pass") & (F.col("lemma") == "werden"),
        "c_aux": F.col("upos") == "AUX",
        "c_als_case": (lemma == "als") & (rel == "case"),
        "c_als_mark": (lemma == "als") & rel.isin("case", "mark"),
        "c_fuer": (lemma == "für") & (rel == "case"),
        "c_wie": (lemma == "wie") & rel.isin("case", "mark"),
        "c_compare": lemma.isin("als", "wie"),
        "c_mehr": (F.col("form") == "mehr") & rel.isin("advmod", "obj"),
    }


FACTS = ["c_case", "c_cop", "c_copula", "c_gen", "c_oblique", "c_passive", "c_aux", "c_als_case", "c_als_mark", "c_fuer", "c_wie", "c_compare", "c_mehr"]
#: What a token keeps for itself, and what it knows of its head.
OWN = ["form", "lemma_text", "upos", "head", "deprel", "case", "verb_form"]


def sentence_trees(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, tree): a sentence's tokens by number, each with the bits of its children's facts (c_bits), the number of
    subjects among them (c_subjects) and the first one's number (c_subject)."""
    t = tokens
    if "lemma_text" not in t.columns:
        t = t.withColumn("lemma_text", F.coalesce(F.nullif("lemma", F.lit("")), "form"))
    bits, found = F.lit(0), facts()
    for i, name in enumerate(FACTS):
        bits = bits + F.when(found[name], 1 << i).otherwise(0)
    subject = F.when((F.col("deprel") == "nsubj") & F.col("upos").isin("ADJ", "NOUN", "VERB"), F.col("id"))
    t = t.select(*keys, "id", *OWN, bits.alias("bits"), subject.cast("int").alias("subject")).repartition(*keys)
    own = F.struct(F.col("id").alias("node"), F.struct("id", *OWN).alias("own"), F.lit(0).alias("bits"), F.lit(None).cast("int").alias("subject"))
    none = F.lit(None).cast(own_type(tokens))
    of_head = F.struct(F.col("head").cast("int").alias("node"), none.alias("own"), "bits", "subject")
    sides = t.select(*keys, F.explode(F.array(own, of_head)).alias("x")).select(*keys, "x.*").where("node > 0")
    nodes = sides.groupBy(*keys, "node").agg(
        F.first("own", True).alias("own"), F.bit_or("bits").alias("c_bits"), F.count("subject").alias("c_subjects"), F.min("subject").alias("c_subject")
    )
    each = F.struct("node", "own.*", "c_bits", "c_subjects", "c_subject")
    return nodes.where("own is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(each)).alias("tree"))


def own_type(tokens: DataFrame) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema}
    return "struct<" + ", ".join(f"`{c}`: {kinds.get(c, 'string')}" for c in ("id", *OWN)) + ">"


def at(tree: Column, number: Column) -> Column:
    """The token of this number; in a tree without gaps it stands at its number."""
    place = F.get(tree, (number - 1).cast("int"))
    return F.when(place["node"] == number, place).otherwise(F.get(F.filter(tree, lambda x: x["node"] == number), 0))


def linked(tokens: DataFrame, *keys: str) -> DataFrame:
    """Every token that has a head (keys, d, h, g): the token, its head, and the head's head, if any."""
    trees = sentence_trees(tokens, *keys)
    pairs = F.transform(F.filter("tree", lambda t: t["head"] > 0), lambda t: F.struct(t.alias("d"), at(F.col("tree"), t["head"]).alias("h")))
    mehr = F.transform(F.filter("tree", lambda t: t["c_bits"].bitwiseAND(F.lit(1 << FACTS.index("c_mehr"))) != 0), lambda t: t["head"])
    three = F.transform(
        F.filter(pairs, lambda x: x["h"].isNotNull()),
        lambda x: F.struct(x["d"].alias("d"), x["h"].alias("h"), at(F.col("tree"), x["h"]["head"]).alias("g"), F.array_contains(mehr, x["h"]["node"]).alias("mehr")),
    )
    return trees.select(*keys, F.explode(three).alias("x")).select(*keys, "x.d", "x.h", "x.g", "x.mehr")


def heads(tokens: DataFrame, *keys: str) -> DataFrame:
    """Every token that has a head, with the head's columns as h_*, and as g_* those of the head's head, if any."""
    e = linked(tokens, *keys)
    bit = lambda x, c: (F.col(f"{x}.c_bits").bitwiseAND(F.lit(1 << FACTS.index(c))) != 0).cast("int")
    mine = [F.col("d.id").alias("id"), *[F.col(f"d.{c}").alias(c) for c in OWN], *[bit("d", c).alias(c) for c in FACTS]]
    upper = [F.col(f"h.{c}").alias(f"h_{c}") for c in OWN] + [bit("h", c).alias(f"h_{c}") for c in FACTS]
    subjects = [F.col("h.c_subjects").alias("h_c_subjects"), F.col("h.c_subject").alias("h_c_subject")]
    comparative = ((bit("h", "c_mehr") == 1) | F.col("mehr")).alias("h_comparative")
    return e.select(*keys, *mine, *upper, *subjects, comparative, F.col("g.upos").alias("g_upos"))


def collocations(tokens: DataFrame, *keys: str, names: list[str] | None = None) -> DataFrame:
    """(keys, rel, n1, n2, n3): all twelve relations, or those of names; n3 is null but for PP."""
    e = heads(tokens, *keys)
    dep, up, gup, rel, hrel = F.col("upos"), F.col("h_upos"), F.col("g_upos"), F.col("deprel"), F.col("h_deprel")
    d, h, g = F.col("id"), F.col("head"), F.col("h_head")
    none = F.lit(None).cast("int")

    def row(name: str | Column, *ids: Column) -> Column:
        ids = (*ids, none)[:3]
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("rel"), *[i.cast("int").alias(f"n{k}") for k, i in enumerate(ids, 1)])

    def either(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests)

    def two(name: str) -> Column:
        return either([(rel == r) & (up == a) & (dep == b) for n, r, a, b in PATTERNS2 if n == name])

    def three(name: str) -> Column:
        return (g > 0) & either([(hrel == r1) & (rel == r2) & (gup == a) & (up == b) & (dep == c) for n, r1, r2, a, b, c in PATTERNS3 if n == name])

    verb = F.col("h_lemma_text")
    skip = (dep == "VERB") & F.coalesce(F.col("verb_form").isin("Fin", "Part"), F.lit(False)) & (F.col("c_aux") == 1)
    one = lambda c: F.col(c) == 1
    case1 = (dep == "NOUN") & (rel == "obl") & verb.isin(*VERBS_ALS_NOUN, *VERBS_ALS_ADJ)
    case2 = dep.isin("ADJ", "VERB") & rel.isin("advcl", "xcomp") & verb.isin(*VERBS_ALS_ADJ)
    open_ = (up == "VERB") & ~skip
    # A comparative verb ends the search for a dependent that one of the first two cases asks about.
    later = open_ & ~((case1 | case2) & F.col("h_comparative"))
    bare = dep.isin("ADJ") & (F.col("c_compare") == 0)
    case = lambda v: F.coalesce(F.col("case") == v, F.lit(False))
    obj = (up == "VERB") & rel.isin("obj", "obl:arg") & (dep == "NOUN") & (F.col("c_case") == 0)
    accusative = (rel == "obj") & (~(case("Dat") | case("Gen") | one("c_oblique")) | case("Acc"))
    found = [
        (F.when(two("ADV"), row("ADV", h, d)), ("ADV",)),
        (F.when(two("ATTR"), row("ATTR", h, d)), ("ATTR",)),
        (F.when(three("PP"), row("PP", g, h, d)), ("PP",)),
        (F.when(three("KON"), row("KON", g, h)), ("KON",)),
        (F.when((rel == "case") & (dep == "CCONJ") & (F.col("form") == "wie") & hrel.isin("obl", "nmod") & (up == "NOUN") & (g > 0) & gup.isin("ADJ", "VERB", "NOUN"), row("KOM", g, h)), ("KOM",)),
        (F.when((up == "NOUN") & (rel == "nmod") & (dep == "NOUN") & case("Gen") & one("c_gen") & (F.col("c_case") == 0), row("GMOD", h, d)), ("GMOD",)),
        (F.when(up.isin("NOUN", "VERB", "ADJ") & (F.col("h_c_cop") == 0) & (rel == "nsubj") & (dep == "NOUN"), row("SUBJA", h, d)), ("SUBJA",)),
        (F.when((up == "VERB") & (rel == "nsubj:pass") & (dep == "NOUN") & one("h_c_passive"), row("SUBJP", h, d)), ("SUBJP",)),
        (F.when(obj, row(F.when(accusative, "OBJ").otherwise("OBJO"), h, d)), ("OBJ", "OBJO")),
        (F.when(up.isin("NOUN", "VERB", "ADJ") & one("h_c_copula") & (F.col("h_c_case") == 0) & (rel == "nsubj") & (dep == "NOUN"), row("PREDC", d, h)), ("PREDC",)),
        (F.when(open_ & case1 & ~F.col("h_comparative") & one("c_als_case"), row("PRED", d, h)), ("PRED",)),
        (F.when(later & case2 & one("c_als_mark"), row("PRED", d, h)), ("PRED",)),
        (F.when(later & dep.isin("ADJ", "NOUN") & rel.isin("obl", "obj", "xcomp") & verb.isin(*VERBS_FUER) & one("c_fuer"), row("PRED", d, h)), ("PRED",)),
        (F.when(later & dep.isin("ADJ", "VERB") & (rel == "advcl") & verb.isin(*VERBS_WIE) & one("c_wie"), row("PRED", d, h)), ("PRED",)),
        (F.when(later & bare & (((verb == "lassen") & (rel == "xcomp")) | ((verb == "aussehen") & (rel == "advcl"))), row("PRED", d, h)), ("PRED",)),
        (F.when(later & bare & (verb == "bleiben") & (rel == "xcomp") & (F.col("h_c_subjects") == 1), row("PREDC", d, F.col("h_c_subject"))), ("PREDC",)),
    ]
    wanted = [x for x, rels in found if names is None or set(rels) & set(names)]
    rows = e.select(*keys, F.explode(F.array_compact(F.array(*wanted))).alias("x"))
    if names is not None:
        rows = rows.where(F.col("x.rel").isin(*names))
    return rows.select(*keys, "x.rel", "x.n1", "x.n2", "x.n3")
