"""CoNLL-U text to sentence rows and back, in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import bound


def pairs_to_map(c: Column) -> Column:
    """k=v|k=v to a map; _ is empty, a later key wins."""

    def last(entries: Column) -> Column:
        distinct = F.array_distinct(F.transform(entries, lambda p: p[0]))
        return bound(distinct, lambda ks: F.map_from_arrays(ks, F.transform(ks, lambda k: F.element_at(F.filter(entries, lambda p: p[0] == k), -1)[1])))

    none = F.create_map().cast("map<string, string>")
    one = bound(F.split(c, "=", 2), lambda p: F.create_map(p[0], p[1]))
    entries = F.transform(F.filter(F.split(c, r"\|"), lambda p: p.contains("=")), lambda p: F.split(p, "=", 2))
    return F.when(~c.contains("="), none).when(~c.contains("|"), one).otherwise(bound(entries, last))


def parse_meta(head: Column) -> Column:
    """Metadata map of lines that begin with #; a later key wins."""

    def last(parts: Column) -> Column:
        keys = F.array_distinct(F.transform(parts, lambda p: p[0]))
        value = lambda k: F.coalesce(F.get(F.element_at(F.filter(parts, lambda p: p[0] == k), -1), 1), F.lit(""))
        return bound(keys, lambda ks: F.map_from_arrays(ks, F.transform(ks, value)))

    parts = F.transform(head, lambda s: F.split(F.regexp_replace(s, r"^#\s*", ""), r"\s*=\s*", 2))
    return bound(F.transform(parts, lambda p: F.concat(F.array(F.trim(p[0])), F.slice(p, 2, 1))), last)


def parse_tokens(body: Column) -> Column:
    """Token array of token lines."""
    none = lambda s: F.nullif(s, F.lit("_"))

    def token(f: Column) -> Column:
        at = lambda i: F.get(f, i)
        return F.struct(
            at(0).cast("int").alias("id"), at(1).alias("form"), none(at(2)).alias("lemma"), none(at(3)).alias("upos"), none(at(4)).alias("xpos"),
            pairs_to_map(at(5)).alias("feats"), none(at(6)).try_cast("int").alias("head"), none(at(7)).alias("deprel"), none(at(8)).alias("deps"), pairs_to_map(at(9)).alias("misc"),
        )

    return F.transform(F.transform(body, lambda s: F.split(s, "\t")), token)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, meta, tokens): a row for each sentence, pos in the order of its file. Gzip files may be read too."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return parse(files.select("file", F.posexplode(F.split("value", r"\r?\n[ \t]*\r?\n")).alias("pos", "block")), "file")


def parse(blocks: DataFrame, *keys: str) -> DataFrame:
    """blocks (keys, pos, block) to (keys, pos, meta, tokens); blocks without tokens and metadata are dropped."""
    is_meta, is_token = (lambda s: s.startswith("#")), (lambda s: s.rlike(r"^[0-9]+\t"))
    lines = F.filter(F.split(F.replace("block", F.lit("\r\n"), F.lit("\n")), "\n"), lambda s: is_meta(s) | is_token(s))
    # A filter would be pushed down to the block's source, and block and lines be made twice; explode_outer is none.
    kept = F.explode_outer(F.filter(F.array(lines), lambda x: F.size(x) > 0))
    out = blocks.select(*keys, "pos", kept.alias("lines")).where(F.col("lines").isNotNull())
    head, body = F.filter("lines", is_meta), F.filter("lines", lambda s: ~is_meta(s))
    return out.select(*keys, "pos", parse_meta(head).alias("meta"), parse_tokens(body).alias("tokens"))


def with_documents(sentences: DataFrame, *keys: str) -> DataFrame:
    """sentences with doc_id and par_no carried forward, and sent_no in the document (keys, pos order them)."""
    order = W.partitionBy(*keys).orderBy("pos")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    doc = F.try_element_at("meta", F.lit("newdoc id"))
    par = F.regexp_extract(F.try_element_at("meta", F.lit("newpar id")), r"(\d+)", 1).try_cast("int")
    out = sentences.withColumns({"doc_id": F.last(doc, True).over(so_far), "doc_no": F.sum(doc.isNotNull().cast("int")).over(so_far)})
    in_doc = W.partitionBy(*keys, "doc_no").orderBy("pos")
    return out.withColumns({"par_no": F.last(par, True).over(in_doc.rowsBetween(W.unboundedPreceding, W.currentRow)), "sent_no": F.row_number().over(in_doc)})


def map_to_pairs(c: Column) -> Column:
    entries = F.when(F.size(c) > 1, F.array_sort(F.map_entries(c))).otherwise(F.map_entries(c))
    found = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    return F.when(F.size(c) > 0, bound(found, lambda x: F.when(x == "", "_").otherwise(x))).otherwise("_")


def serialize(meta: Column, tokens: Column) -> Column:
    """One sentence as text, the empty line at its end included."""
    number = lambda c: F.coalesce(c.cast("string"), F.lit("_"))
    shown = lambda c: F.when(c != "", c).otherwise("_")
    head = F.transform(
        F.map_entries(meta),
        lambda e: F.concat(F.lit("# "), e["key"], F.when(F.coalesce(e["value"], F.lit("")) == "", "").otherwise(F.concat(F.lit(" = "), e["value"]))),
    )
    body = F.transform(
        tokens,
        lambda t: F.concat_ws(
            "\t", number(t["id"]), *[shown(t[c]) for c in ("form", "lemma", "upos", "xpos")], map_to_pairs(t["feats"]), number(t["head"]), shown(t["deprel"]), shown(t["deps"]), map_to_pairs(t["misc"])
        ),
    )
    return F.concat(F.array_join(F.concat(head, body), "\n"), F.lit("\n\n"))


def write(sentences: DataFrame, path: str, sentences_per_file: int = 100_000) -> None:
    """Gzip files below path, one folder for each collection where there is such a column."""
    out = sentences.withColumn("value", F.regexp_replace(serialize(F.col("meta"), F.col("tokens")), "\n\n$", ""))
    cols = ["collection"] if "collection" in sentences.columns else []
    writer = out.select("value", *cols).write.option("lineSep", "\n\n").option("compression", "gzip").option("maxRecordsPerFile", sentences_per_file)
    (writer.partitionBy(*cols) if cols else writer).mode("append").text(path)
