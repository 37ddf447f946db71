"""Registered queries of this subpackage and the SQL that some can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, embedding_dedup, fingerprint, license_scan, line_dedup, minhash_dedup, mixing, quality, search_queries, substring_dedup, toxicity
from tidemark.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    maps = line_dedup.line_keep_bitmaps(docs, min_chars=40, min_docs=5)
    return line_dedup.kept_digests(docs, maps)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mixing.mix(docs, mixing.default_weights(docs), share=0.5, epochs=2, seed=11)
    return out.select("doc_id", "domain", "lang", "source", "n_tokens", F.col("copies").cast("long").alias("copies"), F.round("leaf_budget", 3).alias("leaf_budget"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), threshold=0.93)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, need=80)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.grade(docs, model).select("doc_id", "p_toxic", "severity", "grade", "toxic")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def queries() -> dict:
    return {f.__name__: f for f in (op1_line_dedup, op2_licenses, op3_substring_dedup, op4_quality, op5_mixing, op6_embeddings, op7_fingerprint, op8_minhash, op9_toxicity, op10_bpe)} | search_queries.queries()


ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = r"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM rows),
keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT a.doc_id, a.pos, a.line, (f.k IS NOT NULL AND f.keeper <> a.doc_id) AS gone
  FROM keyed a LEFT JOIN frequent f ON a.k = f.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""



def _fill(src: str, parent: str, child: str) -> str:
    """Shares of ``budget`` by weight, none above ``cap``: the level is the largest of those with the first k children full."""
    return f"""SELECT *, CASE WHEN weight > 0 THEN least(cap, greatest(weight * max(level) OVER (PARTITION BY {parent}), 0)) ELSE 0 END AS give FROM (
    SELECT *, CASE WHEN weight > 0 THEN (budget - coalesce(sum(CASE WHEN weight > 0 THEN cap END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS level
    FROM {src} WINDOW w AS (PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN cap / weight END NULLS LAST, {child}))"""


_TURN = "('0x' || substr(md5({}), 1, 15))::BIGINT"
ORACLES["op5_mixing"] = f"""
WITH r AS (
  SELECT doc_id, lang, source, CASE WHEN n = '' THEN 'other' ELSE 'domain' || (n::BIGINT % 3) END AS domain, md5(t) AS h,
    greatest(len(list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 1)::BIGINT AS n_tokens
  FROM (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, coalesce(text, '') AS t, regexp_extract(coalesce(source, 'none'), '([0-9]{{1,9}})$', 1) AS n FROM documents)),
weights(level, name, weight) AS (VALUES {", ".join(f"('{a}', '{b}', {w}::DOUBLE)" for a, b, w in mixing.WEIGHTS)}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens FROM r GROUP BY ALL),
k3 AS (SELECT l.*, coalesce(w.weight, 1) AS weight, CASE WHEN coalesce(w.weight, 1) > 0 THEN 2 * tokens ELSE 0 END AS cap FROM leaves l LEFT JOIN weights w ON w.level = 'source' AND w.name = l.source),
k2 AS (SELECT l.*, coalesce(w.weight, 1) AS weight, CASE WHEN coalesce(w.weight, 1) > 0 THEN c ELSE 0 END AS cap FROM (SELECT domain, lang, sum(cap) AS c FROM k3 GROUP BY ALL) l LEFT JOIN weights w ON w.level = 'lang' AND w.name = l.lang),
k1 AS (SELECT l.*, coalesce(w.weight, 1) AS weight, CASE WHEN coalesce(w.weight, 1) > 0 THEN c ELSE 0 END AS cap FROM (SELECT domain, sum(cap) AS c FROM k2 GROUP BY ALL) l LEFT JOIN weights w ON w.level = 'domain' AND w.name = l.domain),
g1 AS ({_fill("(SELECT *, least((SELECT sum(tokens) FROM leaves) * 0.5::DOUBLE, sum(cap) OVER ()) AS budget FROM k1)", "1", "domain")}),
g2 AS ({_fill("(SELECT k2.*, g1.give AS budget FROM k2 JOIN g1 ON k2.domain = g1.domain)", "domain", "lang")}),
g3 AS ({_fill("(SELECT k3.*, g2.give AS budget FROM k3 JOIN g2 ON k3.domain = g2.domain AND k3.lang = g2.lang)", "domain, lang", "source")}),
plan AS (SELECT domain, lang, source, give, floor(give / tokens + 1e-12)::BIGINT AS whole, give - floor(give / tokens + 1e-12) * tokens AS rest FROM g3),
placed AS (
  SELECT r.*, p.give, p.whole, p.rest, xor({_TURN.format("'11|' || coalesce(doc_id::VARCHAR, 'none') || '|' || h")}, {_TURN.format("'11|epoch|' || whole::VARCHAR")}) AS place
  FROM r JOIN plan p ON r.domain = p.domain AND r.lang = p.lang AND r.source = p.source)
SELECT doc_id, domain, lang, source, n_tokens, copies, round(give, 3) AS leaf_budget FROM (
  SELECT *, whole + (coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest)::BIGINT AS copies FROM placed) WHERE copies > 0
"""

ORACLES["op6_embeddings"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT r.a AS vec_id, (SELECT count(*) FROM links WHERE links.a = r.a)::BIGINT AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept FROM reach r GROUP BY r.a
"""

ORACLES["op8_minhash"] = r"""
WITH RECURSIVE tok AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM tok),
sized AS (SELECT doc_id, len(s) AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, (SELECT n FROM sized WHERE doc_id = a)::BIGINT AS n_shingles, min(b) AS component_id, min(b) = a AS kept FROM reach GROUP BY a
"""


def oracle_sql() -> dict[str, str]:
    return ORACLES | search_queries.ORACLES
