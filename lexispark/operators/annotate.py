"""Annotators: anything that turns token rows into annotated token rows.

No parser is installed, so StructuralAnnotator gives every token tags and a head by arithmetic on its place and length.
Its trees exercise the tree operators at scale; they say nothing about the language.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UPOS = ["NOUN", "VERB", "ADJ", "ADV", "ADP", "CCONJ", "DET", "PRON", "PUNCT", "AUX", "NOUN", "VERB"]
DEPREL = [
    "nsubj", "obj", "obl", "nmod", "amod", "advmod", "case", "cc", "conj", "cop", "aux:pass", "nsubj:pass", "obl:arg", "xcomp", "advcl", "compound:prt",
]
CASES = ["Nom", "Gen", "Dat", "Acc"]
VERB_FORMS = ["Fin", "Inf", "Part"]
VERBS = ["sein", "werden", "bleiben", "halten", "aussehen", "lassen", "erleben", "sehen", "wirken"]
PARTICLES = ["als", "für", "wie", "mehr"]


class Annotator(Protocol):
    def transform(self, tokens: DataFrame) -> DataFrame: ...


def pick(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))


class StructuralAnnotator:
    """tokens (doc_id, sent_no, id, form) with lemma, upos, head, deprel, case, verb_form; size, the sentence's number of
    tokens, saves the shuffle that counts them."""

    def transform(self, tokens: DataFrame) -> DataFrame:
        i, n = F.col("id"), F.length("form")
        if "size" not in tokens.columns:
            tokens = tokens.withColumn("size", F.count("*").over(W.partitionBy("doc_id", "sent_no")))
        head = 1 + (i * 5 + n * 11) % F.col("size")
        mix = (n * 7919 + i * 104729 + n * i * 31) % 10007
        part = lambda k: F.floor(mix / k).cast("int")
        out = tokens.withColumns(
            {
                "upos": pick(UPOS, part(1)),
                "deprel": pick(DEPREL, part(12)),
                "case": pick(CASES, part(192)),
                "verb_form": pick(VERB_FORMS, part(768)),
                "head": F.when((i == 1) | (head == i), 0).otherwise(head).cast("int"),
            }
        )
        lemma = (
            F.when(F.col("upos").isin("VERB", "AUX"), pick(VERBS, i + n))
            .when(F.col("upos").isin("CCONJ", "ADP") | F.col("deprel").isin("case", "advmod"), pick(PARTICLES, i * 3 + n))
            .otherwise(F.lower("form"))
        )
        out = out.withColumn("lemma", lemma)
        return out.withColumn("form", F.when(F.col("lemma").isin(*PARTICLES), F.col("lemma")).otherwise(F.col("form"))).drop("size")


class LexiconAnnotator:
    """Lemmas from a table (form, upos, lemma) that is joined; the lemma at hand stays where it has none."""

    def __init__(self, lexicon: DataFrame) -> None:
        self.lexicon = lexicon.groupBy("form", "upos").agg(F.min("lemma").alias("found"))

    def transform(self, tokens: DataFrame) -> DataFrame:
        out = tokens.join(self.lexicon, ["form", "upos"], "left")
        return out.withColumn("known", F.col("found").isNotNull()).withColumn("lemma", F.coalesce("found", "lemma")).drop("found")


class PandasAnnotator:
    """A model behind mapInPandas: load() runs once in each Python worker and gives a function from frame to frame."""

    def __init__(self, load, schema: str) -> None:  # noqa: ANN001
        self.load, self.schema = load, schema

    def transform(self, tokens: DataFrame) -> DataFrame:
        load = self.load

        def run(frames):  # noqa: ANN001, ANN202
            model = load()
            for frame in frames:
                yield model(frame)

        return tokens.mapInPandas(run, self.schema)


def phrasal_verbs(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, id, particle_id, compound_prt, compound_verb): a head verb with its separated particle; the last one counts."""
    prt = tokens.where((F.col("deprel") == "compound:prt") & F.col("upos").isin("ADP", "ADJ", "ADV") & (F.lower("form") != "recht") & (F.col("head") > 0))
    prt = prt.select(*keys, F.col("head").alias("id"), F.col("id").alias("particle_id"), F.lower("form").alias("particle"))
    heads = tokens.where(F.col("upos").isin("VERB", "AUX") & (F.col("lemma") != "sein")).select(*keys, "id", "lemma")
    found = prt.join(heads, [*keys, "id"])
    last = F.max(F.struct("particle_id", "particle", "lemma")).alias("x")
    return found.groupBy(*keys, "id").agg(last).select(
        *keys, "id", "x.particle_id", F.col("x.particle").alias("compound_prt"), F.concat("x.particle", "x.lemma").alias("compound_verb")
    )


def with_compounds(tokens: DataFrame, *keys: str) -> DataFrame:
    """tokens with compound_verb, which lemma_text prefers over the lemma."""
    found = phrasal_verbs(tokens, *keys).select(*keys, "id", "compound_prt", "compound_verb")
    return tokens.join(found, [*keys, "id"], "left").withColumn("lemma_text", F.coalesce("compound_verb", F.nullif("lemma", F.lit("")), "form"))


def language(docs: DataFrame, profile: DataFrame, *keys: str) -> DataFrame:
    """(keys, lang, score): the language whose stop words (word, lang) occur most; documents without any are left out."""
    words = docs.select(*keys, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("word"))
    counts = words.join(F.broadcast(profile), "word").groupBy(*keys, "lang").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.max(F.struct("n", "lang")).alias("x")).select(*keys, "x.lang", F.col("x.n").alias("score"))


def example_score(tokens: DataFrame, *keys: str) -> DataFrame:
    """(keys, gdex): share of points for a good example: 6 to 25 tokens, a final mark, a capital first, few pronouns."""
    n = F.count("*")
    points = (
        F.when(n.between(6, 25), 0.4).otherwise(0.0)
        + F.when(F.max_by("form", "id").isin(".", "!", "?"), 0.2).otherwise(0.0)
        + F.when(F.min_by("form", "id").rlike(r"^\p{Lu}"), 0.2).otherwise(0.0)
        + 0.2 * (1 - F.sum((F.col("upos") == "PRON").cast("int")) / n)
    )
    return tokens.groupBy(*keys).agg(points.alias("gdex"))
