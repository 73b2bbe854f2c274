"""Corpus folders, digests and the manifest of what has been converted."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_source(names: list[str]) -> str | None:
    """Of a corpus's folders: xml, or else the last xml-*, or else the last one named as a date."""
    if "xml" in names:
        return "xml"
    for pattern in (r"xml-.*", r"\d{4}-\d\d-\d\d"):
        if found := sorted(n for n in names if re.fullmatch(pattern, n)):
            return found[-1]
    return None


def discover(spark: SparkSession, base: str, groups: tuple[str, ...] = ()) -> dict[str, str]:
    """Corpus name to source folder below base; folders of corpora (groups) are descended into, legacy is left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = lambda p: sorted(s.getPath().getName() for s in fs.listStatus(path(p)) if s.isDirectory())
    out = {}
    for name in folders(base):
        if "legacy" in name:
            continue
        places = [(n, f"{base}/{name}/{n}") for n in folders(f"{base}/{name}")] if name in groups else [(name, f"{base}/{name}")]
        for corpus, place in places:
            if "legacy" not in corpus and (source := newest_source(folders(place))):
                out[corpus] = f"{place}/{source}"
    return out


def sources(spark: SparkSession, corpus: str, path: str) -> DataFrame:
    """(corpus, path, digest) of every .xml file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    return files.select(F.lit(corpus).alias("corpus"), "path", F.sha2("content", 256).alias("digest"))


def latest(manifest: DataFrame) -> DataFrame:
    """The row of each file that was imported last."""
    return manifest.groupBy("corpus", "path").agg(F.max(F.struct("imported", "digest", "import_path")).alias("x")).select("corpus", "path", "x.digest", "x.imported", "x.import_path")


def changed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest does not have with this digest."""
    return files.join(latest(manifest), ["corpus", "path", "digest"], "left_anti")


def unchanged(files: DataFrame, manifest: DataFrame) -> DataFrame:
    return files.join(latest(manifest), ["corpus", "path", "digest"], "left_semi")


def next_manifest(files: DataFrame, manifest: DataFrame, imported, import_path: str) -> DataFrame:  # noqa: ANN001
    """The manifest after a run: files that were converted, or touched, are imported now; others stay as they were.

    A file without sentences is in it too, so it is not tried again.
    """
    now = F.lit(imported).cast("long")
    new = changed(files, manifest).select("corpus", "path", "digest", now.alias("imported"), F.lit(import_path).alias("import_path"))
    old = latest(manifest)
    same = old.join(files.select("corpus", "path", "digest"), ["corpus", "path", "digest"], "left_semi").withColumn("imported", now)
    rest = old.join(files.select("corpus", "path"), ["corpus", "path"], "left_anti")
    return new.unionByName(same).unionByName(rest)


def sampled(files: DataFrame, share: float | None = None, limit: int = 0) -> DataFrame:
    """A share of the files, and of these at most limit (0: all) for each corpus."""
    out = files if share is None else files.where(F.pmod(F.xxhash64("path"), F.lit(10_000)) < int(share * 10_000))
    if limit <= 0:
        return out
    return out.withColumn("_n", F.row_number().over(W.partitionBy("corpus").orderBy("path"))).where(F.col("_n") <= limit).drop("_n")
