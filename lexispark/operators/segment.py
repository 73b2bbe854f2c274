"""Sentences and tokens of plain text by rules, in Catalyst."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sentence ends after one of these marks and white space, or at a line end.
SENTENCE_END = r"([.!?])\s+|\n+"
TOKEN = r"([\p{L}\p{N}]+|[^\s\p{L}\p{N}])(\s*)"
#: What \s matches in it.
SPACE = " \t\n\x0b\f\r"
SEPARATOR = "\u001e"


def sentence_array(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, SENTENCE_END, "$1" + SEPARATOR), SEPARATOR)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def sentences(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, sent_no from 1, sentence)"""
    # Outer, as the optimizer puts a filter on the array's size before explode otherwise, which makes the array twice.
    out = docs.select(*keys, F.posexplode_outer(sentence_array(F.col("text"))).alias("sent_no", "sentence"))
    return out.where(F.col("sent_no").isNotNull()).withColumn("sent_no", F.col("sent_no") + 1)


def token_array(sentence: Column) -> Column:
    """(form, space): tokens of a sentence and whether white space follows; a sentence without any is one token ---."""
    gap = lambda x: reduce(or_, [x.endswith(c) for c in SPACE])
    found = F.transform(F.regexp_extract_all(sentence, F.lit(TOKEN), F.lit(0)), lambda x: F.struct(F.rtrim(x, F.lit(SPACE)).alias("form"), gap(x).alias("space")))
    return F.when(sentence.rlike(r"\S"), found).otherwise(F.array(F.struct(F.lit("---").alias("form"), F.lit(False).alias("space"))))


def tokens(sents: DataFrame, *keys: str, sized: bool = False) -> DataFrame:
    """Long view (keys, sent_no, id from 1, form, space), sized: with the number of the sentence's tokens (size)."""
    rows = sents.select(*keys, "sent_no", token_array(F.col("sentence")).alias("ts"))
    size = [F.size("ts").cast("long").alias("size")] if sized else []
    out = rows.select(*keys, "sent_no", *size, F.posexplode_outer("ts").alias("id", "t"))
    return out.select(*keys, "sent_no", (F.col("id") + 1).alias("id"), "t.form", "t.space", *(["size"] if sized else []))


def segmented(docs: DataFrame, *keys: str) -> DataFrame:
    """Sentence rows with token arrays of the full token type; other fields are null."""
    none = F.lit(None).cast("string")

    def token(t: Column, i: Column) -> Column:
        extra = F.when(t["space"], F.create_map().cast("map<string, string>")).otherwise(F.create_map(F.lit("SpaceAfter"), F.lit("No")))
        return F.struct(
            (i + 1).alias("id"), t["form"].alias("form"), none.alias("lemma"), none.alias("upos"), none.alias("xpos"),
            F.lit(None).cast("map<string, string>").alias("feats"), F.lit(None).cast("int").alias("head"),
            none.alias("deprel"), none.alias("deps"), extra.alias("misc"),
        )

    return sentences(docs, *keys).select(*keys, "sent_no", F.transform(token_array(F.col("sentence")), token).alias("tokens"))
