"""The pipeline's stages one after the other, each recounted by brute force on what the stage before it kept."""

import random
import zlib

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from .test_operators import WORDS, base_spans, brute_hits, brute_near, labelled, tokenizer  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of tables: labelled documents, near copies, benchmark passages, personal data, null and empty texts."""
    r = random.Random(21)
    rows = [[i, t, "en", "s", len(t)] for i, (t, _) in enumerate(labelled(160, 5))]
    items = [" ".join(f"q{r.randrange(500)}" for _ in range(14)) for _ in range(6)] + ["short item here", None]
    for k in range(40):
        words = r.choices(WORDS, k=r.randint(60, 120))
        if k % 4 == 0:
            words[10:10] = items[k % 6].split()
        if k % 5 == 0:
            words[30:30] = [f"user{k}@mail.org", "at", f"10.0.0.{k}"]
        rows.append([len(rows), " ".join(words), "de", "t", None])
        if k % 8 == 0:
            rows.append([len(rows), " ".join([*words[:-1], "changed"]), "de", "t", None])
    rows += [[len(rows), None, None, None, None], [len(rows) + 1, "", None, None, 0]]
    where = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, y) for i, (_, y) in enumerate(labelled(160, 5))], "doc_id long, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where), items


def test_stages(spark, tables, tmp_path):
    from tokenizers import Tokenizer

    where, items = tables
    docs, kept = spark.read.parquet(f"{where}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, where).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()} if k < 4 else docs.collect()
    all_ = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
    labels = {i: y for i, (_, y) in enumerate(labelled(160, 5))}
    # Toxicity: learned; held-out documents are judged as they are labelled, texts stay as they are.
    out = kept["toxicity"]
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((i in out) == (labels[i] == 0) for i in held) and all(all_[i] == t for i, t in out.items()) and len(held) > 10
    assert all(i in out for i in all_ if i not in labels)
    # Near duplicates: the smallest doc_id of each group.
    ids = sorted(out)
    groups = brute_near([out[i] for i in ids], 5, 80)
    assert sorted(kept["near_dedup"]) == [i for n, i in enumerate(ids) if groups[n][1] == n] and len(kept["near_dedup"]) < len(out)
    # Decontamination: no window is left, other documents stay.
    clean = kept["decontamination"]
    pairs = [(i, t) for i, t in enumerate(items)]
    assert not any(hit for _, hit, _ in brute_hits(list(clean.values()), pairs, 10))
    hits = dict(zip(kept["near_dedup"], brute_hits(list(kept["near_dedup"].values()), pairs, 10), strict=True))
    assert all(clean[i] == t for i, t in kept["near_dedup"].items() if not hits[i][1]) and any(h for _, h, _ in hits.values())
    # Personal data: spans of fixed form are replaced.
    for i, t in clean.items():
        want = t
        for a, kind, b in reversed(base_spans(t or "")):
            want = want[:a] + f"<{['email', 'ip', 'card', 'phone'][kind]}>" + want[b:]
        assert kept["personal_data"][i] == want
    assert any("<email>" in (t or "") for t in kept["personal_data"].values())
    # Packing: all ids come back.
    tok = Tokenizer.from_file(tokenizer())
    pieces = {}
    for r in kept["packing"]:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    assert sorted(pieces) == sorted(kept["personal_data"])
    for i, t in kept["personal_data"].items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], np.uint32)
        for start, n, crc in pieces[i]:
            assert zlib.crc32(ids[start : start + n].tobytes()) == crc
        assert sum(n for _, n, _ in pieces[i]) == len(ids)


def test_run_and_empty_tables(spark, tables, tmp_path):
    where, _ = tables
    assert corpus_pipeline.run(spark, where).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{where}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_personal_data_makes_rows_of_its_patterns_alone(spark, tmp_path, monkeypatch):
    """A slot with a common word before its values: no rows for the other words after that word, and the value is redacted."""
    from lexispark.llm import pii_bootstrap

    r = random.Random(9)
    common = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randrange(90)} the" for _ in range(n))
    texts = [f"{common(60)} x call the +49 30 55{i:05d} yes" for i in range(6)] + ["x call the 0305512345 yes", common(800), None]
    spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents")
    made, whole = [], pii_bootstrap.in_context

    def counted(texts, *slots):
        out = whole(texts, *slots)
        if slots:
            made.append(out.count())
        return out

    monkeypatch.setattr(pii_bootstrap, "in_context", counted)
    docs = spark.read.parquet(f"{tmp_path}/documents")
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.personal_data(spark, docs, str(tmp_path)).collect()}
    assert got[6] == "x call the <phone> yes" and got[7] == texts[7] and got[8] is None and len(got) == 9
    assert made and max(made) <= 14, made
