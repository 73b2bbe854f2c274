"""Sentence search for requests of several words, limits, and the tables of examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_TOKENS = 100


def matching(tokens: DataFrame, requests: DataFrame, *keys: str) -> DataFrame:
    """(req_id, keys, hits): sentences with all words of a request (req_id, word), each as lemma or as form.

    The words are joined to the tokens, and a sentence counts if it has as many of them as the request.
    """
    asked = requests.dropDuplicates(["req_id", "word"])
    sizes = asked.groupBy("req_id").agg(F.count("*").alias("n"))
    shown = F.array_distinct(F.array(F.col("form"), F.coalesce("lemma", "form"))) if "lemma" in tokens.columns else F.array("form")
    words = tokens.select(*keys, "id", F.explode(shown).alias("word"))
    found = words.join(F.broadcast(asked) if _small(asked) else asked, "word").groupBy("req_id", *keys)
    found = found.agg(F.count_distinct("word").alias("m"), F.array_sort(F.collect_set("id")).alias("hits"))
    return found.join(F.broadcast(sizes) if _small(sizes) else sizes, "req_id").where("m = n").drop("m", "n")


def _small(df: DataFrame, rows: int = 100_000) -> bool:
    return df.limit(rows + 1).count() <= rows


def limited(rows: DataFrame, limit: int, by: list[str], order: list[Column | str]) -> DataFrame:
    """At most limit rows for each value of by; 0 or less means all."""
    if limit <= 0:
        return rows
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= limit).drop("_n")


def hash_sample(rows: DataFrame, per_mille: int, *keys: str) -> DataFrame:
    """A repeatable share of rows: the first seven hexadecimal digits of a digest of the keys."""
    h = F.conv(F.substr(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), F.lit(1), F.lit(7)), 16, 10).cast("long")
    return rows.where(h % 1000 < per_mille)


def short_enough(sentences: DataFrame) -> DataFrame:
    return sentences.where(F.size("tokens") <= MAX_TOKENS)


def repaired_hits(hits: Column, tokens: Column, words: Column) -> Column:
    """The first and the last hit, and between them the tokens that are a requested word."""
    first, last = F.array_min(hits), F.array_max(hits)
    at = lambda n: F.element_at(tokens, n)
    asked = lambda n: F.array_contains(words, at(n)["form"]) | F.array_contains(words, F.coalesce(at(n)["lemma"], at(n)["form"]))
    return F.when(F.size(hits) > 0, F.filter(F.sequence(first, last), lambda n: (n == first) | (n == last) | asked(n))).otherwise(hits)


def examples(sentences: DataFrame) -> DataFrame:
    """Rows of table example from (req_id, txt, gdex, doc_id, bibl, conll, year, date, embedding), numbered by request."""
    n = F.row_number().over(W.partitionBy("req_id").orderBy(F.col("gdex").desc(), "doc_id", "txt"))
    return sentences.select(
        "req_id", n.alias("n"), "txt", F.col("gdex").cast("double").alias("gdex"), F.col("doc_id").alias("doc"), "bibl", "conll",
        F.col("year").try_cast("smallint").alias("ex_year"), F.col("date").try_cast("date").alias("ex_date"), "embedding",
    )


def example_collocs(rows: DataFrame) -> DataFrame:
    """(req_id, n, collocation): distinct lemma_UPOS of collocates (req_id, n, lemma, upos), sorted."""
    return rows.select("req_id", "n", F.concat_ws("_", "lemma", "upos").alias("collocation")).distinct()


def oldest_job(requests: DataFrame) -> DataFrame:
    """The request (id, lexemes, requested, retrieved) that has waited longest."""
    return requests.where(F.col("retrieved").isNull()).orderBy("requested", "id").limit(1)
