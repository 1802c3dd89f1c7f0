"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, cover_tree, disclosure, language_id, lexical_search, line_dedup, lm_scoring, mixing, packing, simhash, url_filter, warc, whitening
from .common import read_table

#: The listed rules (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Weights that the sources get in turn, and the share of all words that the mix holds.
MIX_WEIGHTS, MIX_SHARE, MIX_CAP = [5, 2, 1], 1.5, 2.0
HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"


def op1_ann_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op2_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_path(spark)
    warc.write_warc(warc.record_types(read_table(spark, sf_dir, "pages"), min_bytes=0), path)
    read = warc.read_warc(spark, path, bodies=False)
    # A response's figures are those of the payload that was read; a revisit has no payload, and its header tells of it.
    response = F.col("kind") == "response"
    return read.select(
        "page_id",
        F.when(response, F.col("body_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("body_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(f"not coalesce({HELD_OUT}, false)"))
    held = docs.withColumn("held_out", F.expr(f"coalesce({HELD_OUT}, false)"))
    return language_id.identify(held, model, keep=["doc_id", "held_out"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), rules, otherwise="allow")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        read_table(spark, sf_dir, "documents"), window=2048, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), with_ids=False
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, new = mixing.mix_sources(docs, MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    taken = (F.col(new["size"]) * F.col(new["copies"])).alias("taken")
    return mixed.select("doc_id", F.col(new["size"]).alias("size"), F.col(new["source_size"]).alias("source_size"), F.col(new["target"]).alias("target"), taken)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=3).select("doc_id", "fingerprint", "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, least=20, min_docs=3)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(read_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backoff", F.round("score", 6).alias("score"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"), k=50)


def op12_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_spans(read_table(spark, sf_dir, "documents"))
    base, added = disclosure.joined(F.col("base")), disclosure.joined(F.col("added"), F.lit(disclosure.TERM_KIND))
    counts = [disclosure.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in disclosure.KINDS]
    spans = F.array_join(F.filter(F.array(base, added), lambda s: s != ""), ",")
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    rows = whitening.whiten(vectors, whitening.learn(vectors, components=16))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_ann_hilbert, op2_cover_tree_dedup, op3_warc_roundtrip, op4_language_id, op5_url_filter,
        op6_packing, op7_mixing, op8_simhash, op9_line_dedup, op10_lm_scoring, op11_lexical_search, op12_sanitisation, op13_whitening,
    ]
    return {f.__name__: f for f in found}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = """
WITH RECURSIVE u AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT DISTINCT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.a AS vec_id, (SELECT count(*) FROM l WHERE l.a = c.a) AS n_links, component_id, c.a = component_id AS kept FROM c
"""

OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, encode(coalesce(html, ''))::BLOB AS raw FROM pages
), d AS (
  SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes, sha1(body) AS h FROM p
), e AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest
  FROM d
), f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM e)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP5_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), j AS (
  SELECT u.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.page_id
)
SELECT u.page_id, u.host, u.path, j.rule, coalesce(j.verdict, 'allow') AS verdict FROM u LEFT JOIN j USING (page_id)
"""

OP7_SQL = f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most, [5.0, 2.0, 1.0][1 + ((place - 1) % 3)]::DOUBLE AS w FROM s
), l AS (
  SELECT *, most / w AS cap_level, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, source_size, least(most, w * (SELECT arg_min(level, cap_level) FROM l WHERE level * w <= most)) AS target FROM l
)
SELECT doc_id, size, source_size, target,
  (size * (floor(target / source_size) + CASE WHEN ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0
    < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

OP9_SQL = rf"""
WITH n AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), e AS (
  SELECT doc_id, i, lines[i] AS line,
    {LOWER.format(r"regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS k
  FROM n, unnest(range(1, len(lines) + 1)) AS t(i)
), s AS (
  SELECT k, max(doc_id) AS keeper FROM e WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), m AS (SELECT e.*, s.k IS NOT NULL AND doc_id <> keeper AS gone FROM e LEFT JOIN s ON e.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER.format("coalesce(text, '')"))} AS w FROM documents
), t AS (
  SELECT doc_id, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a FROM d, unnest(range(1, len(w) + 1)) AS u(i)
), one AS (SELECT b AS g, count(*) AS c FROM t GROUP BY b
), two AS (SELECT a, b, count(*) AS c FROM t WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) >= 2
), x AS (
  SELECT t.doc_id, CASE WHEN two.c IS NOT NULL THEN ln(two.c) - ln(h.c)
      ELSE ln(own.c) - ln((SELECT sum(c) FROM one)) + CASE WHEN t.a IS NOT NULL THEN ln(0.4) ELSE 0 END END AS s,
    (two.c IS NULL AND t.a IS NOT NULL)::INT AS down
  FROM t LEFT JOIN two ON t.a = two.a AND t.b = two.b LEFT JOIN one h ON h.g = t.a JOIN one own ON own.g = t.b
), y AS (SELECT doc_id, count(*) AS n, sum(down) AS down, round(avg(s), 6) AS score FROM x GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(y.down, 0)::BIGINT AS n_backoff, y.score FROM d LEFT JOIN y USING (doc_id)
"""


OP11_TERMS = r"regexp_extract_all(" + LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {OP11_TERMS} AS w FROM documents
), n AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM d WHERE len(w) > 0
), s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n
), q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({OP11_TERMS}) AS t FROM benchmark)
), f AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM n) WHERE t IN (SELECT t FROM q) GROUP BY r, t
), g AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY t, docs
), x AS (
  SELECT item_id, doc_id, sum(g.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n.n * docs) // terms))))::BIGINT AS score
  FROM q JOIN f USING (t) JOIN g USING (t) JOIN n USING (r), s GROUP BY item_id, r, doc_id
), y AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force, a round trip or held-out accuracy."""
    return {
        "op2_cover_tree_dedup": OP2_SQL,
        "op3_warc_roundtrip": OP3_SQL,
        "op5_url_filter": OP5_SQL,
        "op7_mixing": OP7_SQL,
        "op9_line_dedup": OP9_SQL,
        "op10_lm_scoring": OP10_SQL,
        "op11_lexical_search": OP11_SQL,
    }
