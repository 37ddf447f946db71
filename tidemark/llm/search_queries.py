"""Registered queries of the operators on urls, conversations and search, and the SQL that they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import conversation_repair, lexical_search, url_filter
from tidemark.llm.common import table


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report(conversation_repair.damage(rows), every=rows)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), limit=50)


def queries() -> dict:
    return {f.__name__: f for f in (op11_conversation_repair, op12_url_filter, op13_lexical_search)}


ORACLES: dict[str, str] = {}


def _rank_rounds(rounds: int) -> str:
    """Rounds of both ranks, one CTE each; r0 is the seeds."""
    out = []
    for i in range(rounds):
        out.append(f"""r{i + 1} AS MATERIALIZED (
  SELECT kind, host, sum(rank)::BIGINT AS rank FROM (
    SELECT w.kind, w.b AS host, ((r.rank // o.total) * w.n * {url_filter.DAMPING[0]}) // {url_filter.DAMPING[1]} AS rank
    FROM r{i} r JOIN outs o ON o.kind = r.kind AND o.a = r.host JOIN ways w ON w.kind = r.kind AND w.a = r.host WHERE r.rank // o.total > 0
    UNION ALL SELECT kind, host, rank FROM r0) GROUP BY kind, host)""")
    return ",\n".join(out)


def url_filter_sql(rounds: int = url_filter.ROUNDS) -> str:
    lower = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    fits = " UNION ALL ".join(f"SELECT '{v}' AS verdict, '{h}' AS h, '{p}' AS p" for v, h, p in url_filter.RULES)
    link = url_filter.LINK.replace("'", "''")
    return f"""
WITH p AS (
  SELECT row_number() OVER () AS k, page_id, html, translate(regexp_extract(coalesce(url, ''), '{url_filter.URL}', 1), {lower}) AS host, regexp_extract(coalesce(url, ''), '{url_filter.URL}', 2) AS path FROM pages),
rules AS ({fits}),
best AS (
  SELECT k, max(struct_pack(n := length(h || p), verdict := verdict, rule := h || p)) AS best
  FROM p JOIN rules ON (p.host = h OR suffix(p.host, '.' || h)) AND prefix(p.path, rules.p) GROUP BY k),
marked AS (SELECT p.*, best.verdict AS v, best.rule AS rule FROM p LEFT JOIN best USING (k)),
hosts AS (SELECT host, count(*) FILTER (v = 'allow') AS good, count(*) FILTER (v = 'block') AS bad FROM marked WHERE host <> '' GROUP BY host),
links AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1), lambda x: translate(x, {lower})))) AS dst FROM p)
  WHERE src <> '' AND src <> dst GROUP BY ALL),
ways AS MATERIALIZED (SELECT 'trust' AS kind, src AS a, dst AS b, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links),
outs AS MATERIALIZED (SELECT kind, a, sum(n)::BIGINT AS total FROM ways GROUP BY ALL),
r0 AS MATERIALIZED (
  SELECT * FROM (
    SELECT 'trust' AS kind, host, ({url_filter.SEED} * good) // nullif(good + bad, 0) AS rank FROM hosts WHERE good + bad > 0
    UNION ALL SELECT 'distrust', host, ({url_filter.SEED} * bad) // nullif(good + bad, 0) FROM hosts WHERE good + bad > 0) WHERE rank > 0),
{_rank_rounds(rounds)},
last AS (SELECT * FROM r{rounds}),
standing AS (SELECT host, coalesce(sum(rank) FILTER (kind = 'trust'), 0)::BIGINT AS trust, coalesce(sum(rank) FILTER (kind = 'distrust'), 0)::BIGINT AS distrust FROM last GROUP BY host)
SELECT page_id, m.host, path, rule, coalesce(v, CASE WHEN coalesce(distrust, 0) >= {url_filter.TRACE} AND coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM marked m LEFT JOIN standing s ON s.host = m.host AND m.host <> ''
"""


ORACLES["op12_url_filter"] = url_filter_sql()

ORACLES["op13_lexical_search"] = rf"""
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row_number() OVER () AS k, doc_id, terms, len(terms)::BIGINT AS n FROM doc_terms WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs),
asked AS (
  SELECT k, item_id, unnest(list_distinct(regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS k, * FROM benchmark)),
tf AS (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
parts AS (
  SELECT tf.k, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total.terms))) AS part
  FROM tf JOIN docs ON docs.k = tf.k JOIN weights ON weights.term = tf.term, total),
scores AS (SELECT asked.k AS item, any_value(item_id) AS item_id, parts.k, sum(part)::BIGINT AS score FROM asked JOIN parts ON parts.term = asked.term GROUP BY asked.k, parts.k)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST))::INTEGER AS rank, doc_id, score
FROM scores JOIN docs ON docs.k = scores.k WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) <= 50
"""
