"""Tab-separated corpus files with %%$DDC header lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FRAGMENT = r"</?[^>]+>"


def read(spark: SparkSession, path: str, pattern: str = "*.tabs") -> DataFrame:
    """Sentences of all files below path whose name fits, see parse()."""
    options = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return parse(options.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text")))


def header(lines: Column, name: str) -> Column:
    """The last non-empty value of a header."""
    values = F.filter(F.transform(lines, lambda s: F.nullif(F.trim(F.regexp_extract(s, rf"^%%\$DDC:{name}=(.*)$", 1)), F.lit(""))), lambda v: v.isNotNull())
    return F.try_element_at(values, F.lit(-1))


def parse(files: DataFrame) -> DataFrame:
    """files (file, text) to (file, pos, meta, tokens (id, form, lemma, xpos, space)).

    Runs of lines without a blank line are sentences. Field names are declared by header lines and hold until declared
    anew. A token is followed by a space unless the next token, of the next sentence too, has ws 0.
    """
    blocks = files.select("file", F.posexplode(F.split("text", r"\r?\n(?:[ \t]*\r?\n)+")).alias("pos", "block"))
    blocks = blocks.withColumn("lines", F.filter(F.split("block", r"\r?\n"), lambda s: F.trim(s) != "")).where(F.size("lines") > 0)
    heads = F.filter("lines", lambda s: s.startswith("%%$DDC"))
    declared = F.transform(F.filter(heads, lambda s: s.startswith("%%$DDC:index[")), lambda s: F.regexp_extract(s, r"^%%\$DDC:index\[\d+\]=(?:\S+ )?(\S+)\s*$", 1))
    blocks = blocks.withColumns({"heads": heads, "declared": F.when(F.size(declared) > 0, declared)})
    so_far = W.partitionBy("file").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = blocks.withColumn("fields", F.coalesce(F.last("declared", True).over(so_far), F.array().cast("array<string>")))
    rows = F.filter("lines", lambda s: ~s.startswith("%%"))
    values = F.transform(rows, lambda s: F.split(s, "\t"))

    def field(row: Column, name: str) -> Column:
        return F.get(row, F.array_position("fields", F.lit(name)).cast("int") - 1)

    token = lambda r, i: F.struct((i + 1).alias("id"), field(r, "w").alias("form"), field(r, "l").alias("lemma"), field(r, "p").alias("xpos"), field(r, "ws").alias("ws"))
    blocks = blocks.withColumn("raw", F.transform(values, token))
    following = F.lead(F.get("raw", F.lit(0))["ws"]).over(W.partitionBy("file").orderBy("pos"))
    tokens = F.transform("raw", lambda t, i: F.struct(t["id"].alias("id"), t["form"].alias("form"), t["lemma"].alias("lemma"), t["xpos"].alias("xpos"), (F.coalesce(F.get(F.col("raw"), i + 1)["ws"], F.col("following")).eqNullSafe("0") == False).alias("space")))  # noqa: E712
    names = {"newdoc id": r"meta\.basename", "bibl": r"meta\.bibl", "date": r"meta\.date_", "rights": r"meta\.avail"}
    meta = F.map_filter(F.create_map(*[x for k, v in names.items() for x in (F.lit(k), header(F.col("heads"), v))]), lambda k, v: v.isNotNull())
    return blocks.withColumn("following", following).select("file", "pos", meta.alias("meta"), tokens.alias("tokens"))


def without_fragments(sentences: DataFrame, text: Column) -> DataFrame:
    """Sentences with mark-up in their text become a placeholder token where they carry metadata, else they go."""
    broken = text.rlike(FRAGMENT)
    kept = sentences.withColumn("_broken", broken).where(~F.col("_broken") | (F.size("meta") > 0))
    one = F.transform(F.slice("tokens", 1, 1), lambda t: t.withField("form", F.lit("---")).withField("lemma", F.lit("---")))
    return kept.withColumn("tokens", F.when(F.col("_broken"), one).otherwise(F.col("tokens"))).drop("_broken")
