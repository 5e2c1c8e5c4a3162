"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from carelake.llm import bpe, contamination, dedup, jaccard, licences, neardup, negatives, packing, pii, ranked, sharding, toxicity, urls
from carelake.llm.common import table, text_or_empty

BPE_FILE = "byte_bpe_50k.json"
SEQUENCE_TOKENS = 1024
END_ID = 2
#: The url rules of the contract: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(name):
    def add(f):
        QUERIES[name] = f
        return f

    return add


@_query("op1_licence_scan")
def op1_licence_scan(spark, sf_dir):
    return licences.scan_licences(table(spark, sf_dir, "documents"), licences.known_templates(), best_only=True)


@_query("op2_bpe_roundtrip")
def op2_bpe_roundtrip(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


@_query("op3_sharding")
def op3_sharding(spark, sf_dir):
    text = text_or_empty()
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return sharding.shard_by_bytes(sized, 16, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query("op4_jaccard_join")
def op4_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@_query("op7_exact_dedup")
def op7_exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""


@_query("op5_url_filter")
def op5_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLE["op5_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT page_id, min((-length(rhost || rpath), rhost || rpath, rverdict)) AS b
  FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT h.page_id, host, path, b[2] AS rule, coalesce(b[3], 'allow') AS verdict FROM h LEFT JOIN best USING (page_id)
"""


@_query("op6_near_duplicates")
def op6_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


@_query("op8_personal_data")
def op8_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query("op9_packing")
def op9_packing(spark, sf_dir):
    pieces = bpe.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces.drop("ids"), SEQUENCE_TOKENS)


@_query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@_query("op11_decontamination")
def op11_decontamination(spark, sf_dir):
    found = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows), places AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT r, n, p, s FROM places WHERE (n, s) IN (SELECT (n, s) FROM windows)
), covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits JOIN windows USING (n, s) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


@_query("op12_ranked_search")
def op12_ranked_search(spark, sf_dir):
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


ORACLE["op12_ranked_search"] = rf"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
), n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n
), q AS (
  SELECT DISTINCT item_id, t FROM (
    SELECT item_id, unnest(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
), p AS (
  SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t
), w AS (
  SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY t, docs
), impact AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS i
  FROM p JOIN w USING (t) JOIN n USING (doc_id), total
), s AS (
  SELECT item_id, doc_id, CAST(sum(i) AS BIGINT) AS score FROM q JOIN impact USING (t) GROUP BY item_id, doc_id HAVING sum(i) > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10
"""


@_query("op13_hard_negatives")
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


ORACLE["op13_hard_negatives"] = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) WHERE rank <= 3
"""
