"""The operators as queries over the synthetic tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table


def op1_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of documents by law bytes, in the order of doc_id."""
    from .sharding import balanced_shards, byte_size

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", byte_size(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32")
    )
    return balanced_shards(docs, 16, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP2_SQL = """
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
r AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS new FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
s AS (SELECT doc_id, k, min(i) AS lo, max(i) + 400 AS hi FROM g GROUP BY doc_id, k),
p AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM s),
c AS (
  SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
  FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN c.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""


def op2_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents inside strings of 400 bytes that occur twice."""
    from .run_index import repeated_bytes

    found = repeated_bytes(table(spark, sf_dir, "documents"), 400)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


#: Rules of the query over pages.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the rules; a URL that no rule fits is in no list and so allowed."""
    from .url_filter import judge

    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(k, v) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
fits AS (
  SELECT page_id, max_by(k, length(k)) AS rule, max_by(v, length(k)) AS verdict
  FROM u JOIN rules ON ('.' || host) LIKE '%.' || split_part(k, '/', 1) AND starts_with(path, substr(k, strpos(k, '/')))
  GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits ON u.page_id = fits.page_id
"""


def op4_coordinate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents: two-word shingles, similarity 0.8 or more."""
    from .coordinate_join import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP4_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT comp.doc_id, coalesce(n, 0) AS n_shingles, component_id, comp.doc_id = component_id AS kept FROM comp LEFT JOIN n ON comp.doc_id = n.doc_id
"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_digests(pieces: DataFrame, key: str = "doc_id", *more: str) -> DataFrame:
    return pieces.select(
        key, "start", F.expr("octet_length(ids) div 4").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *more
    )


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, at most 1024 segments and 4096 loss-bearing tokens each."""
    from .packing import pack

    return piece_digests(pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of all conversations, each after the turn before it, in sequences with three limits.

    The turn before is a prompt and bears no loss; the limit of loss-bearing tokens ends sequences of long answers, that
    of segments those of short ones.
    """
    from .packing import pack

    turns = table(spark, sf_dir, "conversations")
    before = turns.where("role <> 'assistant'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    answers = turns.where("role = 'assistant'").join(before, ["conv_id", "turn"], "left")
    pieces = pack(answers.select(F.concat_ws(":", "conv_id", "turn").alias("example"), "prompt", "text"), tokenizer_path(), segments=16, loss=3072, prompt="prompt", key="example")
    return piece_digests(pieces, "example", "loss_tokens")


def op6_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for each page, read back through the merged capture index."""
    from .capture_index import captures

    index = captures(table(spark, sf_dir, "pages"), Scratch(spark, "warc").path("archives"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH d AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (
  SELECT page_id, strlen(html) AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first_id,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((CAST('0x' || substr(h, i // 4 * 5 + 1, 5) AS INTEGER) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31) + 1), 1)), '') AS payload_digest
  FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: entities of fixed form, and identifiers discovered by their contexts."""
    from .pii_bootstrap import BASE, personal_data, span_list

    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda x: x["kind_no"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(span_list(F.col("base")), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op8_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a field that learns from the labels of those that are not held out."""
    from .crf import fit, scored

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links among all embeddings of equal labels with a cosine of 0.98 or more."""
    from .projections import linked_vectors

    return linked_vectors(table(spark, sf_dir, "embeddings"), 0.98)


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT comp.vec_id, coalesce(n, 0) AS n_links, component_id, comp.vec_id = component_id AS kept
FROM comp LEFT JOIN counts ON comp.vec_id = counts.vec_id
"""


def op10_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside windows of ten words of benchmark items."""
    from .fm_index import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


OP10_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
phrases AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS p
  FROM b WHERE len(w) > 0),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS p
  FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n),
hits AS (SELECT DISTINCT doc_id, i, grams.n, item_id FROM grams JOIN phrases ON grams.p = phrases.p AND grams.n = phrases.n),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items t ON d.doc_id = t.doc_id
"""


QUERIES = {f.__name__: f for f in (op1_balanced_shards, op2_run_index, op3_url_cascade, op4_coordinate_join, op5_vector_packing, op6_capture_index, op7_bootstrapped_pii, op8_crf_toxicity, op9_projections, op10_fm_decontamination, instruction_packing)}
ORACLE_SQL: dict[str, str] = {
    "op2_run_index": OP2_SQL,
    "op3_url_cascade": OP3_SQL,
    "op4_coordinate_join": OP4_SQL,
    "op6_capture_index": OP6_SQL,
    "op9_projections": OP9_SQL,
    "op10_fm_decontamination": OP10_SQL,
}
