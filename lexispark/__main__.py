"""Commands over files: python -m lexispark COMMAND --help"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import index, relations, segment
from .sources import conllu, corpora, grammar, speech, tabs, tei


def sentences_of(docs: DataFrame, limit: int, sample: float) -> DataFrame:
    """Documents (doc_id, text, ...) as sentences with metadata; a sample keeps every document's first sentence."""
    rows = segment.segmented(docs, "doc_id")
    meta = F.when(F.col("sent_no") == 1, F.create_map(F.lit("newdoc id"), F.col("doc_id"))).otherwise(F.create_map().cast("map<string, string>"))
    rows = rows.withColumn("meta", meta)
    if sample < 1:
        rows = speech.sampled(rows, sample)
    return rows.limit(limit) if limit > 0 else rows


def annotated(sentences: DataFrame) -> DataFrame:
    """Sentences (file, pos, meta, tokens) with the collocations of their trees in the metadata."""
    t = sentences.select("file", "pos", F.explode("tokens").alias("t"))
    long = t.select("file", "pos", "t.id", "t.form", "t.lemma", "t.upos", "t.head", "t.deprel", F.try_element_at("t.feats", F.lit("Case")).alias("case"), F.try_element_at("t.feats", F.lit("VerbForm")).alias("verb_form"))
    found = relations.collocations(long, "file", "pos")
    one = F.struct("rel", F.array_compact(F.array("n1", "n2", "n3")).alias("ids"))
    per = found.groupBy("file", "pos").agg(F.array_sort(F.collect_list(one)).alias("c"))
    from .functions.sentences import collocations_json

    out = sentences.join(per, ["file", "pos"], "left")
    more = F.when(F.col("c").isNull(), F.col("meta")).otherwise(F.map_concat(F.map_filter("meta", lambda k, v: k != "collocations"), F.create_map(F.lit("collocations"), collocations_json(F.col("c")))))
    return out.withColumn("meta", more).drop("c")


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    """Converts files that changed since the last run and writes the manifest of this one."""
    import time

    manifest_path = f"{args.output}/manifest"
    try:
        manifest = spark.read.parquet(manifest_path)
    except Exception:  # noqa: BLE001  there is none yet
        manifest = spark.createDataFrame([], "corpus string, path string, digest string, imported long, import_path string, run long")
    run = int(time.time())
    last = manifest.where(F.col("run") == (manifest.agg(F.max("run")).first()[0] or 0)).drop("run")
    for corpus, path in corpora.discover(spark, args.input).items():
        files = corpora.sampled(corpora.sources(spark, corpus, path), args.sample if args.sample < 1 else None, args.limit)
        new = corpora.changed(files, last.where(F.col("corpus") == corpus))
        wanted = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path).join(new.select("path"), "path", "left_semi")
        rows = sentences_of(tei.extract(wanted.select("path", "content"), corpus).select("doc_id", "text"), 0, 1).withColumn("collection", F.lit(corpus))
        conllu.write(rows, f"{args.output}/sentences/run={run}")
        out = corpora.next_manifest(files, last.where(F.col("corpus") == corpus), run, f"run={run}")
        out.withColumn("run", F.lit(run).cast("long")).write.mode("append").parquet(manifest_path)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexispark")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("segment", "annotate", "tabs", "speech", "convert", "index"):
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--limit", type=int, default=0)
        c.add_argument("--sample", type=float, default=1.0)
        c.add_argument("--pattern", default="*.tabs")
    sub.add_parser("grammar").add_argument("--input", required=True)
    args = p.parse_args(argv)
    if args.command == "grammar":
        with open(args.input, "rb") as f:
            print(grammar.Grammar(f.read()).to_json())
        return 0
    spark = SparkSession.builder.appName("lexispark").getOrCreate()
    if args.command == "segment":
        docs = spark.read.text(args.input, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))
        conllu.write(sentences_of(docs, args.limit, args.sample), args.output)
    elif args.command == "speech":
        conllu.write(sentences_of(speech.read(spark, args.input).select("doc_id", "text"), args.limit, args.sample), args.output)
    elif args.command == "annotate":
        conllu.write(annotated(conllu.read(spark, args.input)), args.output)
    elif args.command == "tabs":
        rows = tabs.read(spark, args.input, args.pattern)
        tabs.without_fragments(rows, F.array_join("tokens.form", " ")).write.mode("overwrite").parquet(args.output)
    elif args.command == "index":
        rows = conllu.with_documents(conllu.read(spark, args.input), "file")
        rows = rows.withColumns({"gdex": F.try_element_at("meta", F.lit("gdex")).try_cast("double"), "lang": F.try_element_at("meta", F.lit("lang"))})
        index.add_command(index.fields(rows)).write.mode("overwrite").text(args.output)
    else:
        convert(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
