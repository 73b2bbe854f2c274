"""Queries against DuckDB on the driver's small tables."""

import os

import duckdb
import pytest

from lexispark.plans import columns, corpus

SF = "/root/testdata/sf0.001"
NAMES = ["token_counts", "contains_all_words", "collocation_counts", "phrasal_verbs", "char_offsets", "manifest_changed", "chat_payloads", "language_id", "conllu_round_trip", "dates", "urns", "nearest_vectors", "short_sentences"]
NAMES += [k for k, f in corpus.QUERIES.items() if f.__module__ == columns.__name__]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("orders", "events", "documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(corpus.ORACLE_SQL[name])
    cols = sorted(want.columns)
    got = corpus.QUERIES[name](spark, SF)
    assert cols == sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    rows = con.sql(f"SELECT {quoted} FROM ({corpus.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_near_duplicate_sentences(spark, tmp_path):
    """Sentences that repeat within a document and across documents; the first in order is kept."""
    rows = [(1, "The cat sat here. A dog ran far away. The cat sat here."), (2, "A dog ran far away.\nSomething else again."), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["sent_no"]): r["kept"] for r in corpus.QUERIES["near_duplicate_sentences"](spark, str(tmp_path)).collect()}
    assert got == {(1, 1): True, (1, 2): True, (1, 3): False, (2, 1): False, (2, 2): True}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_nearest_of_all_rows(spark):
    test_same_as_sql(spark, "nearest_vectors_all")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_postings_of_all_relations(spark):
    """Every collocation of every relation, by brute force over the collected trees' lemmas."""
    from lexispark.operators import relations

    t = corpus.trees(spark, SF).where("doc_id < 40").localCheckpoint()
    lemma = {(r["doc_id"], r["sent_no"], r["id"]): r["lemma"] for r in t.collect()}
    want = set()
    for r in relations.collocations(t, *corpus.KEYS).collect():
        at = (r["doc_id"], r["sent_no"])
        a, b, rel = lemma[(*at, r["n1"])], lemma[(*at, r["n2"])], r["rel"].lower()
        want |= {(*at, n, x) for n in (r["n1"], r["n2"]) for x in (f"c#{rel}#{a}#{b}", f"c#{rel}_#{b}#{a}")}
    got = corpus.QUERIES["collocation_postings_all"](spark, SF).where("doc_id < 40").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len({x.split("#")[1] for *_, x in want}) > 4
