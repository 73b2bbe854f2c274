"""Speeches as XML: text elements with person, titel, datum, ort and url, and a rohtext."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "_person string, _titel string, _untertitel string, _datum string, _ort string, _url string, rohtext string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, bibl, date, text) of every text element below path."""
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").xml(path, rowTag="text")
    return shape(rows)


def shape(rows: DataFrame) -> DataFrame:
    """Missing attributes have fixed stand-ins in bibl; date is the attribute as it is."""
    part = lambda c, other: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(other))
    bibl = F.concat_ws(". ", part("_person", "Anonym"), part("_titel", "ohne Titel"), part("_datum", "n.d"), part("_ort", "o.O"), F.lit(""))
    text = F.trim(F.regexp_replace(F.coalesce("rohtext", F.lit("")), r"\s+", " "))
    return rows.select(F.col("_url").alias("doc_id"), F.trim(bibl).alias("bibl"), F.col("_datum").alias("date"), text.alias("text"))


def sampled(sentences: DataFrame, share: float, seed: int = 1) -> DataFrame:
    """A share of sentences; the first one of each document always stays."""
    return sentences.where((F.col("sent_no") == 1) | (F.rand(seed) < share))
