"""A training-data pipeline: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexispark.llm import coordinate_join, crf, fm_index, packing, pii_bootstrap
from lexispark.llm.common import Scratch, table
from lexispark.llm.queries import held_out, piece_digests, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half; the field learns from all labels that are not held out."""
    model = crf.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return crf.scored(docs, model).where("score < 0.5").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the one with the smallest doc_id."""
    return coordinate_join.deduplicated(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with all windows of ten words of benchmark items cut from their texts."""
    return fm_index.decontaminated(docs, table(spark, sf_dir, "benchmark"), 10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii_bootstrap.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens; smaller batches than alone, since executors are full by now."""
    return piece_digests(packing.pack(docs, tokenizer_path(), batch_bytes=4_000_000))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Packing's pieces and a learned score can't be told by SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs
