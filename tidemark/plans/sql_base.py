"""Common table expressions of the oracle SQL: the same relations as ``sources.binding``, in plain SQL."""

from __future__ import annotations

from tidemark.functions.families import lagged_fields
from tidemark.sources.binding import FULL_FIELDS

_K = "entity, quarter, kind, date"
_LAGS = lagged_fields()

_VALUES = ["ncfdiv", "revenue", "tangibles", "ncfo", "netinc", "fcf", "equity", "sharesbas", "sharefactor"]
CTES: dict[str, tuple[list[str], str]] = {
    "fullf": (["fv"], f"SELECT entity, datekey, reportperiod, {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in FULL_FIELDS.items())} FROM fv"),
    "fullb": (["fullf", "snap"], """
  SELECT s.*, f.* EXCLUDE (entity, rn) FROM snap s ASOF LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, datekey ORDER BY reportperiod DESC) AS rn FROM fullf) WHERE rn = 1) f ON s.entity = f.entity AND s.date > f.datekey"""),
    "full_l": (["fullf", "fullb"], f"""
  SELECT {_K}, {", ".join(f"max({v}) FILTER (k = {n}) AS {v}_t{n}" for v in _LAGS for n in (1, 2, 3))} FROM (
    SELECT *, row_number() OVER (PARTITION BY {_K}, k ORDER BY k_date DESC, period DESC) AS rn FROM (
      SELECT b.entity, b.quarter, b.kind, b.date, f.datekey AS k_date, f.reportperiod AS period, b.reportperiod - f.reportperiod AS gap, round((b.reportperiod - f.reportperiod) / CAST(365 AS DOUBLE))::INT AS k, {", ".join(f"f.{v}" for v in _LAGS)}
      FROM fullb b JOIN fullf f ON b.entity = f.entity AND f.datekey < b.date AND f.reportperiod <= b.reportperiod) WHERE k IN (1, 2, 3) AND abs(gap - k * 365) <= 30) WHERE rn = 1 GROUP BY {_K}"""),
    "full_x": (["fullb", "full_l"], f"""
  SELECT b.*, l.* EXCLUDE ({_K}), CASE WHEN entry * sharesbas * sharefactor > 0 THEN entry * sharesbas * sharefactor END AS marketcap, CASE WHEN entry * sharesbas * sharefactor > 0 THEN entry * sharesbas * sharefactor END + debt - cashneq AS ev
  FROM fullb b LEFT JOIN full_l l ON b.entity = l.entity AND b.quarter = l.quarter AND b.kind = l.kind AND b.date = l.date"""),
    "fulld": (["fullf", "fullb"], """
  SELECT *, CASE WHEN lag(off) OVER w = off + 1 THEN lag(div) OVER w END AS prev_div FROM (
    SELECT *, row_number() OVER (PARTITION BY entity, quarter, kind, date, off ORDER BY k_date DESC, period DESC) AS rn FROM (
      SELECT b.entity, b.quarter, b.kind, b.date, f.datekey AS k_date, f.reportperiod AS period, b.reportperiod - f.reportperiod AS gap, round((b.reportperiod - f.reportperiod) / 365.25::DOUBLE)::INT AS off, -f.ncfdiv AS div
      FROM fullb b JOIN fullf f ON b.entity = f.entity AND f.datekey < b.date AND f.reportperiod <= b.reportperiod) WHERE off < 10 AND abs(gap - off * 365.25::DOUBLE) <= 30)
  WHERE rn = 1 WINDOW w AS (PARTITION BY entity, quarter, kind, date ORDER BY off DESC)"""),
    "fullh": (["fullf", "fullb"], f"""
  SELECT *, {', '.join(f'CASE WHEN lag(off) OVER w = off + 1 THEN lag({v}) OVER w END AS prev_{v}' for v in ('revenue', 'tangibles', 'ncfo'))} FROM (
    SELECT *, row_number() OVER (PARTITION BY entity, quarter, kind, date, off ORDER BY k_date DESC, period DESC) AS rn FROM (
      SELECT b.entity, b.quarter, b.kind, b.date, f.datekey AS k_date, f.reportperiod AS period, b.reportperiod - f.reportperiod AS gap, round((b.reportperiod - f.reportperiod) / 91.3125::DOUBLE)::INT AS off, {', '.join(f'f.{v}' for v in _VALUES)}
      FROM fullb b JOIN fullf f ON b.entity = f.entity AND f.datekey < b.date AND f.reportperiod <= b.reportperiod) WHERE off < 20 AND abs(gap - off * 91.3125::DOUBLE) <= 30)
  WHERE rn = 1 WINDOW w AS (PARTITION BY entity, quarter, kind, date ORDER BY off DESC)"""),
    "sup": ([], """
  SELECT s_suppkey AS entity, 'T' || (s_suppkey - CASE WHEN s_suppkey % 10 = 9 THEN 1 ELSE 0 END) AS ticker,
    CASE WHEN s_suppkey % 10 = 9 THEN DATE '1998-07-01' END AS first_date, CASE WHEN s_suppkey % 10 = 8 THEN DATE '1998-06-30' END AS last_date,
    r_name AS sector, n_name AS industry, CASE WHEN s_suppkey % 13 <> 0 THEN 6000 + s_suppkey * 37 % 900 END AS code,
    CASE WHEN s_suppkey % 11 = 0 THEN 'ADR' WHEN s_suppkey % 7 = 0 THEN 'ETF' ELSE 'Common' END AS category, s_suppkey % 11 = 0 AS delisted
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "li": (["sup"], """
  SELECT sup.ticker, l_suppkey AS entity, l_shipdate::DATE AS date, round(l_extendedprice * 100)::BIGINT AS cents, l_quantity::BIGINT AS qty, (l_returnflag = 'R')::BIGINT AS back
  FROM lineitem JOIN sup ON sup.entity = l_suppkey"""),
    "raw": (["li"], "SELECT ticker, date, sum(cents)::DOUBLE / (100 * sum(qty)::DOUBLE) AS close, sum(qty)::DOUBLE AS volume FROM li GROUP BY ticker, date"),
    "px": (["raw", "sup"], """
  SELECT s.entity, r.date, r.close, r.volume FROM raw r JOIN sup s ON r.ticker = s.ticker
    AND r.date >= coalesce(s.first_date, DATE '0001-01-01') AND r.date <= coalesce(s.last_date, DATE '9999-12-31')"""),
    "bench": (["li"], "SELECT date, sum(cents)::DOUBLE / (100 * sum(qty)::DOUBLE) AS bench FROM li GROUP BY date"),
    "cal": (["px"], "SELECT date, row_number() OVER (ORDER BY date) AS ix FROM (SELECT DISTINCT date FROM px)"),
    "fq": (["li"], """
  SELECT entity, date_trunc('quarter', date)::DATE AS q, sum(cents)::DOUBLE / 100.0::DOUBLE AS rev, sum(qty)::DOUBLE AS qty, sum(back)::DOUBLE AS back, count(*)::DOUBLE AS lines
  FROM li GROUP BY 1, 2"""),
    "fv": (["fq"], """
  SELECT *, (q + INTERVAL 3 MONTH)::DATE - 1 AS reportperiod, (q + INTERVAL 3 MONTH)::DATE - 1 + 45 AS datekey, 1.0::DOUBLE AS f FROM fq
  UNION ALL SELECT *, (q + INTERVAL 3 MONTH)::DATE - 1, (q + INTERVAL 3 MONTH)::DATE - 1 + 115, 1.25::DOUBLE FROM fq WHERE (year(q) * 4 + quarter(q)) % 7 = 0"""),
    "fil": (["fv"], """
  SELECT entity, datekey, reportperiod, rev * f AS revenue, rev * f * 0.5::DOUBLE - qty * 100 AS gp, rev * 0.25::DOUBLE - qty * back * 50 AS netinc, rev * 0.125::DOUBLE - back * 1000 AS ncfo,
    rev * 2 + qty AS assets, rev * 0.75::DOUBLE + back * 500 AS liabilities, rev * 0.5::DOUBLE AS assetsc, rev * 0.25::DOUBLE + lines * 100 AS liabilitiesc, rev * 0.125::DOUBLE AS cash,
    rev * 0.5::DOUBLE AS debt, rev * 0.25::DOUBLE - lines * 200 AS ebit, rev * 0.5::DOUBLE - back * 2000 AS retearn, qty * 10 AS shares, CASE WHEN back > 2 THEN back * 10 ELSE 0::DOUBLE END AS dividends
  FROM fv"""),
    "fil1": (["fil"], "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, datekey ORDER BY reportperiod DESC) AS rn FROM fil) WHERE rn = 1"),
    "qstat": (["px"], """
  SELECT entity, date_trunc('quarter', date)::DATE AS quarter, count(*) AS n_days, min(close) AS low, max(close) AS high, quantile_disc(close, 0.5) AS median FROM px GROUP BY 1, 2"""),
    "snap": (["px", "qstat"], """
  SELECT q.entity, q.quarter, q.n_days, k.kind, p.close AS entry, min(p.date) AS date
  FROM qstat q CROSS JOIN (VALUES ('median'), ('low'), ('high')) k(kind)
  JOIN px p ON p.entity = q.entity AND date_trunc('quarter', p.date)::DATE = q.quarter AND p.close = CASE k.kind WHEN 'median' THEN q.median WHEN 'low' THEN q.low ELSE q.high END
  GROUP BY ALL"""),
    "nominal": (["snap", "cal"], """
  SELECT d.date, h.h, (d.date + to_years(h.h))::DATE AS target FROM (SELECT DISTINCT date FROM snap) d CROSS JOIN (VALUES (1), (2), (3), (5)) h(h)
  WHERE (d.date + to_years(h.h))::DATE <= (SELECT max(date) FROM cal)"""),
    "ends": (["nominal", "cal"], "SELECT n.date, n.h, c.date AS end_date, c.ix AS end_ix FROM nominal n ASOF JOIN cal c ON n.target >= c.date"),
    "win": (["ends", "cal"], "SELECT e.date, e.h, c.ix - e.end_ix + 20 AS pos, c.date AS day FROM ends e JOIN cal c ON c.ix BETWEEN e.end_ix - 20 AND e.end_ix"),
    "path": (["snap", "win", "px"], """
  SELECT s.entity, s.quarter, s.kind, s.date, s.entry, w.h, w.pos, w.day, p.close FROM (snap s JOIN win w ON s.date = w.date) ASOF JOIN px p ON s.entity = p.entity AND w.day >= p.date"""),
    "term": (["path"], """
  SELECT entity, quarter, kind, date, entry, h, avg(close) AS avg_end, min(close) AS min_end, max(close) AS max_end, max_by(close, pos) AS last_end FROM path GROUP BY ALL"""),
    "bterm": (["win", "bench"], """
  SELECT w.date, w.h, avg(b.bench) AS bench_end, any_value(e.bench) AS bench_entry
  FROM (win w ASOF JOIN bench b ON w.day >= b.date) JOIN (SELECT x.date, b.bench FROM (SELECT DISTINCT date FROM win) x ASOF JOIN bench b ON x.date >= b.date) e ON e.date = w.date GROUP BY w.date, w.h"""),
    "lab": (["term", "bterm"], """
  SELECT *, cagr - bench_cagr AS excess, cagr > bench_cagr AS beat0 FROM (
    SELECT t.*, pow(avg_end / entry, 1.0::DOUBLE / t.h) - 1 AS cagr, pow(last_end / entry, 1.0::DOUBLE / t.h) - 1 AS p2p, pow(min_end / entry, 1.0::DOUBLE / t.h) - 1 AS cagr_min,
      pow(max_end / entry, 1.0::DOUBLE / t.h) - 1 AS cagr_max, pow(b.bench_end / b.bench_entry, 1.0::DOUBLE / t.h) - 1 AS bench_cagr, greatest(0, 1 - min_end / entry) AS loss
    FROM term t LEFT JOIN bterm b ON t.date = b.date AND t.h = b.h)"""),
    "reasons": (["px", "sup", "li"], """
  SELECT e.entity, e.last_date, e.last_close, coalesce(a.action, 'unknown') AS reason FROM (
    SELECT s.entity, s.ticker, max(p.date) AS last_date, max_by(p.close, p.date) AS last_close FROM sup s JOIN px p ON p.entity = s.entity WHERE s.delisted GROUP BY ALL) e
  LEFT JOIN (SELECT entity, action FROM (SELECT x.entity, b.action, row_number() OVER (PARTITION BY x.entity ORDER BY list_position(['bankruptcyliquidation', 'regulatorydelisting', 'voluntarydelisting', 'acquisitionby', 'mergerfrom', 'delisted'], b.action), b.date) AS rn
    FROM (SELECT s.entity, s.ticker, max(p.date) AS last_date FROM sup s JOIN px p ON p.entity = s.entity WHERE s.delisted GROUP BY ALL) x
    JOIN (SELECT ticker, last + ((entity % 41) * n)::INT AS date, ['delisted', 'mergerfrom', 'bankruptcyliquidation', 'acquisitionby', 'regulatorydelisting', 'voluntarydelisting'][(entity + 2 * n) % 6 + 1] AS action
      FROM (SELECT s.entity, s.ticker, max(l.date) AS last FROM sup s JOIN li l ON l.entity = s.entity WHERE s.delisted GROUP BY ALL), (VALUES (0), (1)) v(n)) b
    ON b.ticker = x.ticker AND b.date BETWEEN x.last_date - 30 AND x.last_date + 30) WHERE rn = 1) a ON a.entity = e.entity"""),
    "labx": (["lab", "ends", "reasons"], """
  SELECT l.*, e.end_date, CASE WHEN r.last_date < e.end_date THEN r.reason ELSE 'false' END AS ended, round(cagr, 9) >= 0 AS cagr_ge_0, round(cagr, 9) >= 0.05::DOUBLE AS cagr_ge_5, round(cagr, 9) >= 0.08::DOUBLE AS cagr_ge_8, round(cagr, 9) >= 0.10::DOUBLE AS cagr_ge_10,
    round(cagr, 9) >= 0.15::DOUBLE AS cagr_ge_15, round(cagr, 9) >= 0.20::DOUBLE AS cagr_ge_20, round(excess, 9) >= 0.05::DOUBLE AS excess_ge_5, round(excess, 9) >= 0.10::DOUBLE AS excess_ge_10, round(excess, 9) > 0 AS beat
  FROM lab l JOIN ends e ON e.date = l.date AND e.h = l.h LEFT JOIN reasons r ON r.entity = l.entity"""),
    "base": (["snap", "fil1"], """
  SELECT s.*, f.* EXCLUDE (entity, rn) FROM snap s ASOF LEFT JOIN fil1 f ON s.entity = f.entity AND s.date > f.datekey"""),
    "known": (["base", "fil"], """
  SELECT b.entity, b.quarter, b.kind, b.date, f.datekey AS k_date, f.reportperiod AS period, f.revenue, f.netinc, f.dividends, b.reportperiod - f.reportperiod AS gap
  FROM base b JOIN fil f ON b.entity = f.entity AND f.datekey < b.date AND f.reportperiod <= b.reportperiod"""),
    "lagged": (["known"], """
  SELECT entity, quarter, kind, date, max(revenue) FILTER (k = 1) AS revenue_t1, max(revenue) FILTER (k = 2) AS revenue_t2, max(revenue) FILTER (k = 3) AS revenue_t3 FROM (
    SELECT *, row_number() OVER (PARTITION BY entity, quarter, kind, date, k ORDER BY k_date DESC, period DESC) AS rn FROM (SELECT *, round(gap / 365.0::DOUBLE)::INT AS k FROM known)
    WHERE k IN (1, 2, 3) AND abs(gap - k * 365) <= 30) WHERE rn = 1 GROUP BY ALL"""),
    "hist": (["known"], """
  SELECT *, CASE WHEN prev_off = off + 1 THEN prev_r END AS prev_revenue, CASE WHEN prev_off = off + 1 THEN prev_d END AS prev_dividends FROM (
    SELECT *, lag(off) OVER w AS prev_off, lag(revenue) OVER w AS prev_r, lag(dividends) OVER w AS prev_d FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, quarter, kind, date, off ORDER BY k_date DESC, period DESC) AS rn FROM (SELECT *, round(gap / 91.3125::DOUBLE)::INT AS off FROM known)
      WHERE off < 20 AND abs(gap - off * 91.3125::DOUBLE) <= 30) WHERE rn = 1 WINDOW w AS (PARTITION BY entity, quarter, kind, date ORDER BY off DESC))"""),
    "divh": (["known"], """
  SELECT *, CASE WHEN prev_off = off + 1 THEN prev_d END AS prev_dividends FROM (
    SELECT *, lag(off) OVER w AS prev_off, lag(dividends) OVER w AS prev_d FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, quarter, kind, date, off ORDER BY k_date DESC, period DESC) AS rn FROM (SELECT *, round(gap / 365.25::DOUBLE)::INT AS off FROM known)
      WHERE off < 10 AND abs(gap - off * 365.25::DOUBLE) <= 30) WHERE rn = 1 WINDOW w AS (PARTITION BY entity, quarter, kind, date ORDER BY off DESC))"""),
    "feat": (["base", "lagged"], """
  SELECT b.*, l.revenue_t1, l.revenue_t2, l.revenue_t3, CASE WHEN entry * shares > 0 THEN entry * shares END AS marketcap, CASE WHEN entry * shares > 0 THEN entry * shares END + debt - cash AS ev
  FROM base b LEFT JOIN lagged l ON b.entity = l.entity AND b.quarter = l.quarter AND b.kind = l.kind AND b.date = l.date"""),
    "fam": (["feat"], """
  SELECT *, CASE WHEN marketcap > 0 THEN netinc / marketcap END AS earnings_yield, CASE WHEN marketcap > 0 THEN revenue / marketcap END AS sales_yield, CASE WHEN marketcap > 0 THEN dividends / marketcap END AS dividend_yield,
    CASE WHEN ev > 0 THEN ebit / ev END AS ebit_to_ev, CASE WHEN revenue > 0 THEN gp / revenue END AS gross_margin, CASE WHEN assets > 0 THEN netinc / assets END AS roa,
    CASE WHEN assets > 0 THEN debt / assets END AS debt_to_assets, CASE WHEN revenue_t1 > 0 THEN (revenue - revenue_t1) / revenue_t1 END AS revenue_growth_1y FROM feat"""),
    "ser": (["px", "cal"], """
  SELECT entity, date, ix, close, close / prev - 1 AS ret, ln(close / prev) AS log_ret, close * volume AS dollar, coalesce(prev_ix = ix - 1, false) AS one_day FROM (
    SELECT p.*, c.ix, lag(p.close) OVER w AS prev, lag(c.ix) OVER w AS prev_ix FROM px p JOIN cal c ON p.date = c.date WINDOW w AS (PARTITION BY p.entity ORDER BY c.ix))"""),
    "bret": (["bench", "cal"], "SELECT ix, CASE WHEN lag(ix) OVER w = ix - 1 THEN ln(bench / lag(bench) OVER w) END AS bench_log_ret FROM (SELECT c.ix, b.bench FROM bench b JOIN cal c ON b.date = c.date) WINDOW w AS (ORDER BY ix)"),
    "obs": (["snap", "cal"], """
  SELECT s.entity, s.quarter, s.kind, s.date, h.h, (s.date + to_years(h.h))::DATE AS label_end, (s.date + to_years(h.h))::DATE <= (SELECT max(date) FROM cal) AS observable
  FROM snap s CROSS JOIN (VALUES (1), (2), (3), (5)) h(h)"""),
    "folds": (["obs"], """
  SELECT 'holdout' AS scheme, y1 AS fold, h, make_date(y1, 1, 1) AS test_start, DATE '9999-12-31' AS test_end FROM (SELECT h, min(year(date)) AS y0, max(year(date)) AS y1 FROM obs WHERE observable GROUP BY h)
  UNION ALL SELECT 'walkforward', f.y, h, make_date(f.y, 1, 1), make_date(f.y + 1, 1, 1) FROM (SELECT h, min(year(date)) AS y0, max(year(date)) AS y1 FROM obs WHERE observable GROUP BY h) s, unnest(generate_series(s.y0 + 2 + s.h, s.y1 - 1)) f(y)"""),
    "tags": (["obs", "folds"], """
  SELECT * FROM (SELECT o.*, f.scheme, f.fold, CASE WHEN o.date < f.test_start THEN CASE WHEN o.label_end + 30 < f.test_start THEN 'train' WHEN o.label_end < f.test_start THEN 'embargoed' ELSE 'purged' END
    WHEN o.date < f.test_end AND o.kind = 'median' THEN 'test' END AS role FROM obs o JOIN folds f ON o.h = f.h WHERE o.observable) WHERE role IS NOT NULL"""),
}


def sql(body: str, *needs: str, instead: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``body`` with the expressions that it needs, and those that they need, before it; ``instead`` replaces some of them."""
    known = {**CTES, **(instead or {})}
    order: list[str] = []

    def add(name: str) -> None:
        for x in known[name][0]:
            add(x)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({known[n][1]})" for n in order) + "\n" + body if order else body


def filed_on_the_day(snap: tuple[list[str], str]) -> dict[str, tuple[list[str], str]]:
    """Expressions in which ``snap`` stands for the snapshots, and a filing of the snapshot's own date is known."""
    out = {"snap": snap}
    for name, (needs, body) in CTES.items():
        looser = body.replace("s.date > f.datekey", "s.date >= f.datekey").replace("f.datekey < b.date", "f.datekey <= b.date")
        if looser != body:
            out[name] = (needs, looser)
    return out
