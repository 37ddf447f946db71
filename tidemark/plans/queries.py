"""Registered queries of the panel operators, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, ShortType

from tidemark.functions import families as fam
from tidemark.functions import registry as reg
from tidemark.functions.exprs import md5_number, round6
from tidemark.operators import fundamentals as fu
from tidemark.operators import identity as idn
from tidemark.operators import panel as pn
from tidemark.operators import quality_reports as qr
from tidemark.operators import snapshots as sn
from tidemark.operators.asof import asof_join, validity_join
from tidemark.operators.bands import band_stats
from tidemark.operators.paths import path_days, path_stats, paths, price_runs
from tidemark.plans import wide
from tidemark.plans.sql_base import filed_on_the_day, sql
from tidemark.sources import binding as bind
from tidemark.sources.checks import checked
from tidemark.sources.io import bucketed, materialized

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RECIPES: dict[str, tuple[str, tuple[str, ...]]] = {}  # body of the SQL and the expressions that it needs
KEY = ["entity", "quarter", "kind", "date"]
EXACT = {"close", "volume", "entry", "last_close", "price", "min_price", "max_price", "last_price", *[f"{c}_{h}y" for c in ("last_end", "min_end", "max_end") for h in sn.HORIZONS]}  # quotients of whole numbers, equal in any engine; rounding would meet ties


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as long, floating ones rounded to 6 places, as the SQL has them."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (IntegerType, ShortType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in EXACT:
            c = round6(c) if isinstance(f.dataType, DoubleType) else F.round(c, 6) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, body: str, *needs: str):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: tidy(f(spark, sf_dir))
        RECIPES[name] = (body, needs)
        ORACLES[name] = sql(body, *needs)
        return f

    return keep


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in cols)


class World:
    """The relations of one data directory.  Those that other steps build on are written once for a query and read from there.

    Prices and snapshots are bucketed by entity, so steps within an entity shuffle nothing.
    """

    exact = False  # whether a filing of the snapshot's own date is known

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @cached_property
    def prices(self) -> DataFrame:
        return bucketed(checked(bind.prices(self.spark, self.dir), "prices", ["entity", "date"]), ["entity"], dealt=True)

    @cached_property
    def calendar(self) -> DataFrame:
        return materialized(sn.trading_calendar(self.prices))

    @cached_property
    def snaps(self) -> DataFrame:
        return bucketed(sn.touch_snapshots(self.prices), ["entity"], dealt=True)

    @cached_property
    def ends(self) -> DataFrame:
        return materialized(sn.horizon_ends(self.snaps, self.calendar))

    @property
    def windows(self) -> DataFrame:
        return sn.terminal_windows(self.ends, self.calendar)

    def asks(self, horizons: tuple[int, ...] = sn.HORIZONS, kinds: tuple[str, ...] = sn.KINDS, unlabelled: bool = False) -> DataFrame:
        """Snapshots with the horizon ends of their date as an array, empty (``unlabelled``) or left out where there is none."""
        at = self.ends.where(F.col("h").isin(*horizons)).groupBy("date").agg(F.collect_list(F.struct("h", "end_date", "end_ix")).alias("ends"))
        s = self.snaps if kinds == sn.KINDS else self.snaps.where(F.col("kind").isin(*kinds))
        return s.select("entity", "quarter", "kind", "date", "n_days", "entry").join(F.broadcast(at), "date", "left" if unlabelled else "inner").select("entity", "quarter", "kind", "date", "n_days", "entry", "ends")

    def bench(self, horizons: tuple[int, ...] = sn.HORIZONS) -> DataFrame:
        w = self.windows if horizons == sn.HORIZONS else self.windows.where(F.col("h").isin(*horizons))
        return sn.bench_stats(w, bind.benchmark(self.spark, self.dir))

    def flagged(self, horizons: tuple[int, ...] = sn.HORIZONS, kinds: tuple[str, ...] = sn.KINDS) -> DataFrame:
        """Labels whose growth is rounded to 9 places before it meets a threshold, as sums in another order may differ beyond that."""
        return self.labels(lambda c: F.round(c, 9), horizons, kinds)

    def labels(self, tie=lambda c: c, horizons: tuple[int, ...] = sn.HORIZONS, kinds: tuple[str, ...] = sn.KINDS) -> DataFrame:
        """Labels of these horizons and kinds; no others are made."""
        return sn.label_long(sn.span_rows(sn.span_stats(self.prices, self.calendar, self.asks(horizons, kinds))), self.bench(horizons), tie=tie)

    def drawdowns(self) -> DataFrame:
        return sn.span_rows(sn.span_stats(self.prices, self.calendar, self.asks())).select("entity", "kind", "date", "h", "max_drawdown", "fall_from_entry")

    def wide_labels(self) -> DataFrame:
        """Every label column of every horizon, with n_days and entry of the snapshot; snapshots without labels stay."""
        return sn.label_wide(sn.span_stats(self.prices, self.calendar, self.asks(unlabelled=True)), self.bench(), _reasons(self), tuple(_WIDE_LABEL), tie=lambda c: F.round(c, 9))

    @cached_property
    def runs(self) -> DataFrame:
        return materialized(price_runs(self.prices, self.calendar))

    def path_asks(self, window: int = 21) -> DataFrame:
        """The last ``window`` trading days of each horizon of each snapshot."""
        asks = self.snaps.select("entity", "quarter", "kind", "date").join(F.broadcast(self.ends.select("date", "h", "end_ix")), "date")
        return asks.withColumn("start_ix", F.greatest(F.col("end_ix") - (window - 1), F.lit(1)))

    @cached_property
    def filings(self) -> DataFrame:
        return materialized(checked(bind.filings(self.spark, self.dir), "filings", ["entity", "datekey", "reportperiod"]))

    def base(self, allow_exact: bool = False) -> DataFrame:
        f = self.filings
        return fu.fund_base(self.snaps, f, [c for c in f.columns if c not in ("entity", "datekey", "reportperiod")], allow_exact)

    @property
    def filed(self) -> DataFrame:
        """Snapshots with the day and period of their filing only."""
        return fu.fund_base(self.snaps.select(*KEY), self.filings.select("entity", "datekey", "reportperiod"), [])

    @cached_property
    def known(self) -> DataFrame:
        """``base``, written for steps that use it more than once."""
        return materialized(self.base())

    def features(self) -> DataFrame:
        return fu.market_inputs(self.base().join(fu.lag_values(self.filings, ["revenue"]), fu.FILED, "left"))

    def families(self) -> DataFrame:
        return fu.quality_family(fu.solvency(fu.growth_family(fu.profitability(fu.valuation(self.features())))))

    def observations(self, horizons: tuple[int, ...] = sn.HORIZONS) -> DataFrame:
        last = self.calendar.agg(F.max("date").alias("__last"))
        o = self.snaps.withColumn("h", F.explode(F.array(*map(F.lit, horizons)))).withColumn("label_end", F.add_months("date", F.col("h") * 12))
        return o.crossJoin(F.broadcast(last)).withColumn("observable", F.col("label_end") <= F.col("__last")).select(*KEY, "h", "label_end", "observable")


# -- identity ---------------------------------------------------------------------------------------------


@query("dedup_latest", "SELECT o_custkey, o_orderkey, o_orderdate::DATE AS o_orderdate, round(o_totalprice, 6) + 0.0::DOUBLE AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1")
def _(s, d):
    return idn.dedup_latest(bind.table(s, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")


@query("key_reuse", "SELECT entity, ticker, count(*) OVER (PARTITION BY ticker) > 1 AS is_reused FROM sup", "sup")
def _(s, d):
    return idn.flag_reuse(bind.entities(s, d).select("entity", "ticker"), "ticker")


_FLAGS = """SELECT entity, coalesce(category IN ('Common'), false) AS is_category, coalesce(code BETWEEN 6000 AND 6499, false) AS is_financial, code IS NULL AS code_missing,
  coalesce((sector = 'ASIA') <> coalesce(code BETWEEN 6000 AND 6499, false), false) AS sector_disagrees, coalesce(category IN ('Common'), false) AND NOT coalesce(code BETWEEN 6000 AND 6499, false) AS in_universe FROM sup"""


def _flags(s, d):
    return idn.universe_flags(bind.entities(s, d), "category", "code", "sector", ["Common"], excluded_sector="ASIA").select("entity", "is_category", "is_financial", "code_missing", "sector_disagrees", "in_universe")


query("universe_flags", _FLAGS, "sup")(_flags)


@query("universe_summary", f"SELECT count(*) AS n_rows, count(*) FILTER (is_category) AS n_category, count(*) FILTER (is_financial) AS n_financial, count(*) FILTER (code_missing) AS n_code_missing, count(*) FILTER (in_universe) AS n_universe FROM ({_FLAGS})", "sup")
def _(s, d):
    return idn.universe_summary(_flags(s, d))


@query("active_by_year", """SELECT y.y::BIGINT AS year, count(*) AS n_active, count(*) FILTER (l IS NOT NULL) AS n_ended FROM (
  SELECT l_suppkey AS e, min(l_shipdate)::DATE AS f, CASE WHEN l_suppkey % 11 = 0 THEN max(l_shipdate)::DATE END AS l FROM lineitem GROUP BY l_suppkey) s,
  unnest(generate_series(greatest(year(f), 1996), year(coalesce(l, DATE '2001-12-31')))) y(y) GROUP BY 1""")
def _(s, d):
    life = bind.table(s, d, "lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").cast("date").alias("f"), F.max("l_shipdate").cast("date").alias("x")).withColumn("l", F.when(F.col("l_suppkey") % 11 == 0, F.col("x")))
    return idn.active_by_year(life, "f", "l", 1996, F.lit("2001-12-31").cast("date"))


@query("price_resolution", "SELECT entity, date, close, volume FROM px", "px")
def _(s, d):
    return bind.prices(s, d)


@query("filing_resolution", """SELECT entity, datekey, reportperiod, round(revenue, 6) + 0.0::DOUBLE AS revenue, owner FROM (
  SELECT f.*, m.entity AS owner, row_number() OVER (PARTITION BY f.entity, f.datekey, f.reportperiod ORDER BY greatest(coalesce(m.first_date - f.datekey, 0), coalesce(f.datekey - m.last_date, 0), 0), m.entity) AS rn
  FROM (SELECT fil.*, sup.ticker FROM fil JOIN sup ON sup.entity = fil.entity) f JOIN (SELECT *, count(*) OVER (PARTITION BY ticker) > 1 AS reused FROM sup) m ON f.ticker = m.ticker
    AND (NOT m.reused OR (f.datekey >= coalesce(m.first_date - 540, DATE '0001-01-01') AND f.datekey <= coalesce(m.last_date + 366, DATE '9999-12-31')))) WHERE rn = 1""", "fil", "sup")
def _(s, d):
    e = bind.entities(s, d)
    f = bind.filings(s, d).join(e.select("entity", "ticker"), "entity")
    m = idn.flag_reuse(e, "ticker").withColumnRenamed("entity", "owner")
    return validity_join(f, m, "ticker", "datekey", "first_date", "last_date", "owner", 540, 366, True, "is_reused", ["entity", "datekey", "reportperiod"]).select("entity", "datekey", "reportperiod", "revenue", "owner")


@query("end_reasons", "SELECT * FROM reasons", "reasons")
def _(s, d):
    return _reasons(World(s, d))


def _reasons(w) -> DataFrame:
    return idn.end_reasons(bind.entities(w.spark, w.dir), bind.endings(w.spark, w.dir), idn.last_prints(w.prices))


@query("unplaceable", "SELECT count(*) AS n_rows, count(*) FILTER (first_date IS NULL) AS n_unplaceable, count(*) FILTER (first_date IS NULL AND last_date IS NOT NULL) AS n_only_end FROM sup", "sup")
def _(s, d):
    return idn.unplaceable(bind.entities(s, d), "first_date", "last_date")


@query("universe_prices", f"SELECT p.entity, p.date, p.close, p.volume FROM px p JOIN ({_FLAGS}) f ON f.entity = p.entity WHERE f.in_universe AND p.close > 0", "sup", "px")
def _(s, d):
    return idn.in_universe(bind.prices(s, d), _flags(s, d), "close")


# -- calendar and as-of -------------------------------------------------------------------------------------


@query("trading_calendar", "SELECT date, ix FROM cal", "cal")
def _(s, d):
    return World(s, d).calendar


def _asof(exact: bool, tolerance: int | None = None):
    def run(s, d):
        o = bind.table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("t"))
        p = bind.table(s, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("u"), "l_quantity").groupBy("k", "u").agg(F.sum("l_quantity").alias("v"))
        return asof_join(o, p, ["k"], "t", "u", ["v"], "left", exact, tolerance).select("o_orderkey", "u", "v")

    return run


_P = "(SELECT l_suppkey AS k, l_shipdate::DATE AS u, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)"
query("asof_inclusive", f"SELECT o_orderkey, p.u, round(p.v, 6) + 0.0::DOUBLE AS v FROM orders o ASOF LEFT JOIN {_P} p ON o.o_custkey = p.k AND o.o_orderdate::DATE >= p.u")(_asof(True))
query("asof_strict", f"SELECT o_orderkey, p.u, round(p.v, 6) + 0.0::DOUBLE AS v FROM orders o ASOF LEFT JOIN {_P} p ON o.o_custkey = p.k AND o.o_orderdate::DATE > p.u")(_asof(False))
query("asof_tolerance", f"SELECT o_orderkey, CASE WHEN o.o_orderdate::DATE - p.u <= 14 THEN p.u END AS u, CASE WHEN o.o_orderdate::DATE - p.u <= 14 THEN round(p.v, 6) + 0.0::DOUBLE END AS v FROM orders o ASOF LEFT JOIN {_P} p ON o.o_custkey = p.k AND o.o_orderdate::DATE >= p.u")(_asof(True, 14))


@query("touch_snapshots", "SELECT entity, quarter, n_days, kind, date, entry FROM snap", "snap")
def _(s, d):
    return World(s, d).snaps.select("entity", "quarter", "n_days", "kind", "date", "entry")


@query("horizon_ends", "SELECT date, h::BIGINT AS h, end_date, end_ix FROM ends", "ends")
def _(s, d):
    return World(s, d).ends


@query("terminal_windows", "SELECT date, h::BIGINT AS h, pos, day FROM win", "win")
def _(s, d):
    return World(s, d).windows


LADDER = [*[f"cagr_ge_{p}" for p in sn.CAGR_PCT], *[f"excess_ge_{p}" for p in sn.EXCESS_PCT], "beat"]
_GROWTH = ["cagr", "p2p", "cagr_min", "cagr_max", "bench_cagr", "excess", "loss"]


@query("forward_cagr", f"SELECT entity, quarter, kind, h::BIGINT AS h, {r6(*_GROWTH)}, {', '.join(LADDER)} FROM labx", "labx")
def _(s, d):
    return World(s, d).flagged().select("entity", "quarter", "kind", "h", *_GROWTH, *LADDER)


@query("delisted_labels", "SELECT entity, quarter, kind, h::BIGINT AS h, end_date, ended FROM labx", "labx")
def _(s, d):
    w = World(s, d)
    return sn.delisted_in_window(w.labels(), _reasons(w)).select("entity", "quarter", "kind", "h", "end_date", "ended")


_ENDS = ["avg_end", "last_end", "min_end", "max_end"]
_FALLS = ["max_drawdown", "fall_from_entry"]
_WIDE_LABEL = [*_ENDS, *_GROWTH, *_FALLS, *LADDER, "ended"]
_DRAWDOWN = """SELECT entity, kind, date, h::BIGINT AS h, round(max(dd), 6) + 0.0::DOUBLE AS max_drawdown, round(greatest(1 - min(close) / any_value(entry), 0), 6) + 0.0::DOUBLE AS fall_from_entry FROM (
  SELECT s.entity, s.kind, s.date, s.entry, e.h, p.close, 1 - p.close / max(p.close) OVER (PARTITION BY s.entity, s.kind, s.date, e.h ORDER BY p.date) AS dd
  FROM snap s JOIN ends e ON s.date = e.date JOIN px p ON p.entity = s.entity AND p.date BETWEEN s.date AND e.end_date) GROUP BY entity, kind, date, h"""


def _wide_label(h: int, c: str) -> str:
    v = f"max({'d' if c in _FALLS else 'l'}.{c}) FILTER (l.h = {h})"
    return (f"round({v}, 6) + 0.0::DOUBLE" if c in ("avg_end", *_GROWTH, *_FALLS) else v) + f" AS {c}_{h}y"


_LABEL_WIDE = f"""SELECT s.entity, s.quarter, s.kind, s.date, s.n_days, s.entry, {', '.join(_wide_label(h, c) for h in sn.HORIZONS for c in _WIDE_LABEL)}
FROM snap s LEFT JOIN labx l ON s.entity = l.entity AND s.quarter = l.quarter AND s.kind = l.kind LEFT JOIN ({_DRAWDOWN}) d ON d.entity = l.entity AND d.kind = l.kind AND d.date = l.date AND d.h = l.h
GROUP BY s.entity, s.quarter, s.kind, s.date, s.n_days, s.entry"""


@query("label_wide", _LABEL_WIDE, "snap", "labx", "ends", "px")
def _(s, d):
    return World(s, d).wide_labels()


@query("label_summary", f"SELECT h::BIGINT AS h, count(*) AS n, count(*) FILTER (ended <> 'false') AS n_ended, {', '.join(f'count(*) FILTER ({c}) AS n_{c}' for c in LADDER)}, round(avg(cagr), 6) + 0.0::DOUBLE AS mean_cagr FROM labx GROUP BY h", "labx")
def _(s, d):
    w = World(s, d)
    return sn.delisted_in_window(w.flagged(), _reasons(w)).groupBy("h").agg(F.count("*").alias("n"), F.count_if(F.col("ended") != "false").alias("n_ended"), *[F.count_if(c).alias(f"n_{c}") for c in LADDER], F.avg("cagr").alias("mean_cagr"))


@query("snapshot_summary", "SELECT kind, count(*) AS n, count(DISTINCT entity) AS n_entities, min(date) AS first_date, max(date) AS last_date, round(median(n_days), 6) + 0.0::DOUBLE AS median_days FROM snap GROUP BY kind", "snap")
def _(s, d):
    return sn.snapshot_summary(World(s, d).snaps)


@query("max_drawdown", _DRAWDOWN, "snap", "ends", "px")
def _(s, d):
    return World(s, d).drawdowns()


@query("forward_paths", """SELECT p.entity, p.quarter, p.kind, p.h::BIGINT AS h, p.pos, p.day, p.close AS price, p.day > l.last AS is_extension
FROM path p JOIN (SELECT entity, max(date) AS last FROM px GROUP BY entity) l ON l.entity = p.entity""", "path", "px")
def _(s, d):
    w = World(s, d)
    key = ["entity", "quarter", "kind", "h", "end_ix"]
    p = path_days(paths(w.path_asks(), w.runs, key), w.calendar)
    return p.select("entity", "quarter", "kind", "h", (F.col("ix") - F.col("end_ix") + 20).alias("pos"), "day", "price", "is_extension")


@query("path_stats", """SELECT p.entity, p.quarter, p.kind, p.h::BIGINT AS h, count(*) AS n_days, round(avg(p.close), 6) + 0.0::DOUBLE AS avg_price, min(p.close) AS min_price,
  max(p.close) AS max_price, max_by(p.close, p.pos) AS last_price, count(*) FILTER (p.day > l.last) AS n_extension
FROM path p JOIN (SELECT entity, max(date) AS last FROM px GROUP BY entity) l ON l.entity = p.entity GROUP BY p.entity, p.quarter, p.kind, p.h""", "path", "px")
def _(s, d):
    w = World(s, d)
    key = ["entity", "quarter", "kind", "h"]
    return path_stats(paths(w.path_asks(), w.runs, key), key)


# -- fundamentals -------------------------------------------------------------------------------------------

_K = "entity, quarter, kind, date"


@query("fund_base", f"SELECT {_K}, datekey, reportperiod, {r6('revenue', 'assets')} FROM base", "base")
def _(s, d):
    return World(s, d).base().select(*KEY, "datekey", "reportperiod", "revenue", "assets")


@query("meta_features", f"SELECT {_K}, (date - datekey)::BIGINT AS age_days, coalesce(date - datekey <= 135, false) AS fresh_135, coalesce(date - datekey <= 400, false) AS fresh_400, netinc < 0 AS loss_making, assets - liabilities < 0 AS negative_equity FROM base", "base")
def _(s, d):
    return fu.meta(World(s, d).base()).select(*KEY, "age_days", "fresh_135", "fresh_400", "loss_making", "negative_equity")


@query("lag_match", f"SELECT b.entity, b.quarter, b.kind, b.date, {', '.join(f'round(l.revenue_t{k}, 6) + 0.0::DOUBLE AS revenue_t{k}' for k in (1, 2, 3))} FROM base b LEFT JOIN lagged l ON b.entity = l.entity AND b.quarter = l.quarter AND b.kind = l.kind AND b.date = l.date", "base", "lagged")
def _(s, d):
    w = World(s, d)
    return fu.lag_match(w.filed, w.filings, KEY, "revenue")


@query("history_buckets", f"SELECT {_K}, off::BIGINT AS off, {r6('revenue', 'prev_revenue')} FROM hist", "hist")
def _(s, d):
    w = World(s, d)
    return fu.history_buckets(w.filed, w.filings, KEY, ["revenue"]).select(*KEY, "off", "revenue", "prev_revenue")


@query("dividend_record", f"""SELECT {_K}, count(dividends) AS years_known, count(*) FILTER (dividends > 0) AS years_paid, count(*) FILTER (ok) AS streak, count(*) FILTER (prev_dividends > 0 AND dividends < 0.8::DOUBLE * prev_dividends) AS cuts FROM (
  SELECT *, bool_and(dividends > 0 AND off = rn2 - 1) OVER (PARTITION BY {_K} ORDER BY off ROWS UNBOUNDED PRECEDING) AS ok FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY off) AS rn2 FROM divh)) GROUP BY ALL""".replace("GROUP BY ALL", f"GROUP BY {_K}"), "divh")
def _(s, d):
    w = World(s, d)
    return fu.at_filing(w.filed, fu.dividend_record(fu.filing_history(w.filings, ["dividends"], 10, fu.YEAR_DAYS), fu.FILED, "dividends"), KEY, "inner")


def _trend_sql() -> str:
    cols = []
    for w, least in {4: 3, 8: 5, 12: 7, 20: 11}.items():
        ok = f"count(*) FILTER (off < {w} AND revenue > 0) >= {least} AND count(*) FILTER (off < {w} AND revenue <= 0) = 0"
        x, y, good = "-off / 4.0::DOUBLE", "ln(CASE WHEN revenue > 0 THEN revenue END)", f"off < {w} AND revenue > 0"
        pair = f"off <= {w - 2} AND prev_revenue IS NOT NULL AND revenue IS NOT NULL"
        cols += [
            f"round(CASE WHEN {ok} THEN regr_slope({y}, {x}) FILTER ({good}) END, 6) + 0.0::DOUBLE AS revenue_slope_{w}", f"round(CASE WHEN {ok} THEN regr_r2({y}, {x}) FILTER ({good}) END, 6) + 0.0::DOUBLE AS revenue_r2_{w}",
            f"round(CASE WHEN count(*) FILTER ({pair}) >= {least - 1} THEN (count(*) FILTER ({pair} AND revenue > prev_revenue))::DOUBLE / count(*) FILTER ({pair}) END, 6) + 0.0::DOUBLE AS revenue_up_{w}",
            f"count(*) FILTER (off < {w} AND revenue IS NOT NULL) AS revenue_n_{w}",
        ]
    return f"SELECT {_K}, {', '.join(cols)} FROM hist GROUP BY {_K}"


@query("trend_features", _trend_sql(), "hist")
def _(s, d):
    w = World(s, d)
    return fu.at_filing(w.filed, fu.trend_stats(fu.filing_history(w.filings, ["revenue"]), fu.FILED, "revenue"), KEY, "inner")


_SERIES = wide.SERIES


def _trend_family_sql() -> str:
    cols = []
    for v, name in _SERIES.items():
        for w, least in fu.TREND_WINDOWS.items():
            ok = f"count(*) FILTER (off < {w} AND {v} > 0) >= {least} AND count(*) FILTER (off < {w} AND {v} <= 0) = 0"
            pair = f"off <= {w - 2} AND prev_{v} IS NOT NULL AND {v} IS NOT NULL"
            fit = lambda f: f"round(CASE WHEN {ok} THEN {f}(ln(CASE WHEN {v} > 0 THEN {v} END), -off / 4.0::DOUBLE) FILTER (off < {w} AND {v} > 0) END, 6) + 0.0::DOUBLE"  # noqa: B023, E731
            cols += [f"{fit('regr_slope')} AS {name}_trend_{w}q", f"{fit('regr_r2')} AS {name}_consistency_{w}q"]
            cols.append(f"round(CASE WHEN count(*) FILTER ({pair}) >= {least - 1} THEN (count(*) FILTER ({pair} AND {v} > prev_{v}))::DOUBLE / count(*) FILTER ({pair}) END, 6) + 0.0::DOUBLE AS {name}_up_frac_{w}q")
            if name == "ocf":
                cols.append(f"round(CASE WHEN count({v}) FILTER (off < {w}) >= {least} THEN (count(*) FILTER (off < {w} AND {v} > 0))::DOUBLE / count({v}) FILTER (off < {w}) END, 6) + 0.0::DOUBLE AS {name}_positive_frac_{w}q")
    return f"SELECT {_K}, {', '.join(cols)}, count(*) AS fund_history_quarters FROM fullh GROUP BY {_K}"


@query("trend_family", _trend_family_sql(), "fullh")
def _(s, d):
    return wide.Features(World(s, d)).trend()


@query("market_inputs", f"SELECT {_K}, {r6('marketcap', 'ev')} FROM feat", "feat")
def _(s, d):
    return fu.market_inputs(World(s, d).base()).select(*KEY, "marketcap", "ev")


def _div(n: str, m: str) -> str:
    return f"CASE WHEN {m} > 0 THEN {n} / ({m}) END"


_FAMILY_SQL = {
    "valuation_features": {"earnings_yield": _div("netinc", "marketcap"), "sales_yield": _div("revenue", "marketcap"), "cash_yield": _div("ncfo", "marketcap"), "ebit_to_ev": _div("ebit", "ev"), "book_yield": _div("(assets - liabilities)", "marketcap"), "ev_to_marketcap": _div("ev", "marketcap"), "dividend_yield": _div("dividends", "marketcap")},
    "profitability_features": {"gross_margin": _div("gp", "revenue"), "net_margin": _div("netinc", "revenue"), "roa": _div("netinc", "assets"), "roe": _div("netinc", "assets - liabilities"), "gp_to_assets": _div("gp", "assets"), "accruals": _div("(netinc - ncfo)", "assets")},
    "growth_features": {"revenue_growth_1y": _div("(revenue - revenue_t1)", "revenue_t1"), "revenue_cagr_3y": "CASE WHEN revenue_t3 > 0 AND revenue >= 0 THEN pow(revenue / revenue_t3, 1.0::DOUBLE / 3) - 1 END"},
    "solvency_features": {
        "current_ratio": _div("assetsc", "liabilitiesc"), "debt_to_assets": _div("debt", "assets"),
        "altman_z2": f"6.56 * {_div('(assetsc - liabilitiesc)', 'assets')} + 3.26 * {_div('retearn', 'assets')} + 6.72 * {_div('ebit', 'assets')} + 1.05 * {_div('(assets - liabilities)', 'liabilities')}",
        "zmijewski": f"-4.336 - 4.513 * {_div('netinc', 'assets')} + 5.679 * {_div('liabilities', 'assets')} + 0.004 * {_div('assetsc', 'liabilitiesc')}",
    },
    "quality_features": {"f_score": "(netinc > 0)::INT + (ncfo > 0)::INT + (ncfo > netinc)::INT + (revenue > revenue_t1)::INT", "revenue_sd": "CASE WHEN revenue_t1 IS NOT NULL AND revenue_t2 IS NOT NULL AND revenue_t3 IS NOT NULL THEN list_stddev_samp([revenue, revenue_t1, revenue_t2, revenue_t3]) END"},
}


def _family(cols: list[str]):
    return lambda s, d: World(s, d).families().select(*KEY, *cols)


for _name, _cols in _FAMILY_SQL.items():
    _body = ", ".join(f"({e})::BIGINT AS {c}" if c == "f_score" else f"round({e}, 6) + 0.0::DOUBLE AS {c}" for c, e in _cols.items())
    query(_name, f"SELECT {_K}, {_body} FROM feat", "feat")(_family(list(_cols)))


_RATIOS = wide.RATIOS
_REL = ", ".join(
    f"round(CASE WHEN count(h.{r}) >= 11 AND median(h.{r}) > 0 THEN any_value(f.{r}) / median(h.{r}) END, 6) + 0.0::DOUBLE AS {r}_vs_5y_median, "
    f"round(CASE WHEN count(h.{r}) >= 11 AND any_value(f.{r}) IS NOT NULL THEN (count(*) FILTER (h.{r} < f.{r}) + count(*) FILTER (h.{r} = f.{r}) / 2.0::DOUBLE) / count(h.{r}) END, 6) + 0.0::DOUBLE AS {r}_5y_pctile"
    for r in _RATIOS
)
_NOW = ", ".join(f"CASE WHEN entry * sharesbas * sharefactor > 0 THEN {v} / (entry * sharesbas * sharefactor) END AS {r}" for r, v in _RATIOS.items())
_THEN = ", ".join(f"CASE WHEN c.close * b.sharesbas * b.sharefactor > 0 THEN b.{v} / (c.close * b.sharesbas * b.sharefactor) END AS {r}" for r, v in _RATIOS.items())


@query("relvalue_features", f"""SELECT f.entity, f.quarter, f.kind, f.date, {_REL} FROM (SELECT {_K}, {_NOW} FROM fullb) f
  JOIN (SELECT b.entity, b.quarter, b.kind, b.date, {_THEN} FROM (SELECT *, least(k_date, period + 45) AS anchor FROM fullh) b ASOF JOIN px c ON b.entity = c.entity AND b.anchor >= c.date WHERE b.anchor - c.date <= 14) h
  ON f.entity = h.entity AND f.quarter = h.quarter AND f.kind = h.kind AND f.date = h.date GROUP BY f.entity, f.quarter, f.kind, f.date""", "fullb", "fullh", "px")
def _(s, d):
    return wide.Features(World(s, d)).relvalue()


@query("returns_series", f"SELECT entity, date, ix, {r6('ret', 'log_ret', 'dollar')}, one_day FROM ser", "ser")
def _(s, d):
    w = World(s, d)
    return fu.returns_series(w.prices, w.calendar).select("entity", "date", "ix", "ret", "log_ret", "dollar", "one_day")


_TECHNICAL = reg.columns("technical", late=False)


def _technical_sql(year: int, three: int, five: int, month: int) -> str:
    ref = lambda k: f"arg_max(close, ix) FILTER (b >= {k} AND b <= {k} + 21)"
    return f"""SELECT t.entity, t.quarter, t.kind, t.date, {r6(*_TECHNICAL)}, n_obs FROM (SELECT entity, quarter, kind, date, {ref(21)} / {ref(252)} - 1 AS mom_12_2, {ref(252)} / {ref(756)} - 1 AS mom_36_12, any_value(entry) / {ref(126)} - 1 AS ret_6m, any_value(entry) / {ref(21)} - 1 AS ret_1m,
  CASE WHEN count(*) FILTER (b < 21 AND one_day) >= {month} THEN max(ret) FILTER (b < 21 AND one_day) END AS max_ret_21d,
  CASE WHEN count(log_ret) FILTER (b < 252) >= {year} THEN stddev_samp(log_ret) FILTER (b < 252) * sqrt(252.0::DOUBLE) END AS vol_12m, CASE WHEN count(log_ret) FILTER (b < 756) >= {three} THEN stddev_samp(log_ret) FILTER (b < 756) * sqrt(252.0::DOUBLE) END AS vol_36m,
  CASE WHEN count(*) FILTER (b < 252 AND one_day AND bench_log_ret IS NOT NULL) >= {year} THEN regr_slope(log_ret, bench_log_ret) FILTER (b < 252 AND one_day AND bench_log_ret IS NOT NULL) END AS beta_12m,
  any_value(entry) / max(close) FILTER (b < 252) - 1 AS dist_52w_high, CASE WHEN count(close) FILTER (b < 1260) >= {five} THEN any_value(entry) / max(close) FILTER (b < 1260) - 1 END AS dist_5y_high, CASE WHEN count(close) FILTER (b < 1260) >= {five} THEN any_value(entry) / avg(close) FILTER (b < 1260) - 1 END AS price_vs_5y_avg,
  median(dollar) FILTER (b < 63) AS dollar_volume_3m, avg(abs(ret) / dollar) FILTER (b < 252) AS amihud_12m, count(*) AS n_obs
FROM (SELECT s.entity, s.quarter, s.kind, s.date, s.entry, c.ix - r.ix AS b, r.ix, r.close, r.ret, r.log_ret, r.dollar, r.one_day, m.bench_log_ret FROM snap s JOIN cal c ON c.date = s.date
  JOIN ser r ON r.entity = s.entity AND r.ix BETWEEN c.ix - 1260 AND c.ix LEFT JOIN bret m ON m.ix = r.ix) GROUP BY entity, quarter, kind, date) t
LEFT JOIN (SELECT {_K}, CASE WHEN marketcap > 0 THEN ln(marketcap) END AS log_marketcap FROM feat) f ON t.entity = f.entity AND t.quarter = f.quarter AND t.kind = f.kind AND t.date = f.date"""


@query("technical_features", _technical_sql(200, 600, 1000, 15), "snap", "cal", "ser", "bret", "feat")
def _(s, d):
    return wide.technical(World(s, d))


@query("technical_features_sparse", _technical_sql(15, 45, 75, 2), "snap", "cal", "ser", "bret", "feat")
def _(s, d):
    """The same with fewer observations needed, as the entities of the test tables have few prints a year."""
    return wide.technical(World(s, d), **wide.SPARSE)


# -- cross-section ------------------------------------------------------------------------------------------

_RANKED = ["earnings_yield", "sales_yield", "gross_margin", "roa"]


def _ranked_sql(cols: dict[str, tuple[float, float] | None], part: str, src: str = "fam") -> str:
    out = []
    for c, pin in cols.items():
        side = f"sign({c} - {pin[0]})" if pin else "0"
        pr = f"percent_rank() OVER (PARTITION BY {part}, {c} IS NULL, {side} ORDER BY {c})"
        r = f"CASE WHEN {side} = 0 THEN {pin[1]} WHEN {side} < 0 THEN {pr} * {pin[1]} ELSE {pin[1]} + (1 - {pin[1]}) * {pr} END" if pin else pr
        out.append(f"round(CASE WHEN {c} IS NOT NULL AND count({c}) OVER (PARTITION BY {part}) >= 20 THEN {r} END, 6) + 0.0::DOUBLE AS {c}_rank")
    return f"SELECT {_K}, {', '.join(out)} FROM {src}"


@query("full_rank", _ranked_sql(dict.fromkeys(_RANKED), "quarter, kind"), "fam")
def _(s, d):
    return pn.cross_rank(World(s, d).families(), KEY, dict.fromkeys(_RANKED), ["quarter", "kind"])


@query("pinned_rank", _ranked_sql({"dividend_yield": (0.0, 0.5), "roa": (0.0, 0.25)}, "quarter, kind"), "fam")
def _(s, d):
    return pn.cross_rank(World(s, d).families(), KEY, {"dividend_yield": (0.0, 0.5), "roa": (0.0, 0.25)}, ["quarter", "kind"])


@query("sector_rank", _ranked_sql({"roa": None}, "quarter, kind, sector", "(SELECT f.*, s.sector FROM fam f JOIN sup s ON f.entity = s.entity)"), "fam", "sup")
def _(s, d):
    f = World(s, d).families().join(bind.entities(s, d).select("entity", "sector"), "entity")
    return pn.cross_rank(f, KEY, {"roa": None}, ["quarter", "kind", "sector"])


@query("composites", """SELECT entity, quarter, kind, date, round(CASE WHEN count(s) OVER w >= 20 AND s IS NOT NULL THEN percent_rank() OVER (PARTITION BY quarter, kind, s IS NULL ORDER BY s) END, 6) + 0.0::DOUBLE AS magic_rank FROM (
  SELECT entity, quarter, kind, date, round(CASE WHEN ebit_to_ev IS NOT NULL AND count(ebit_to_ev) OVER p >= 20 THEN percent_rank() OVER (PARTITION BY quarter, kind, ebit_to_ev IS NULL ORDER BY ebit_to_ev) END
    + CASE WHEN roa IS NOT NULL AND count(roa) OVER p >= 20 THEN percent_rank() OVER (PARTITION BY quarter, kind, roa IS NULL ORDER BY roa) END, 9) AS s FROM fam WINDOW p AS (PARTITION BY quarter, kind)) WINDOW w AS (PARTITION BY quarter, kind)""", "fam")
def _(s, d):
    f = World(s, d).families()
    r = pn.cross_rank(f, KEY, {"ebit_to_ev": None, "roa": None}, ["quarter", "kind"]).withColumn("magic", F.round(F.col("ebit_to_ev_rank") + F.col("roa_rank"), 9))
    return pn.cross_rank(r, KEY, {"magic": None}, ["quarter", "kind"])


@query("group_medians_g", """SELECT f.entity, f.quarter, f.kind, f.date, round(m.roa, 6) + 0.0::DOUBLE AS med_roa, ((f.ncfo > f.netinc)::INT + (f.roa > m.roa)::INT + (f.gross_margin > m.gm)::INT)::BIGINT AS g_score
FROM (SELECT f.*, s.sector FROM fam f JOIN sup s ON f.entity = s.entity) f LEFT JOIN (SELECT f.quarter, f.kind, s.sector, CASE WHEN count(roa) >= 5 THEN median(roa) END AS roa, CASE WHEN count(gross_margin) >= 5 THEN median(gross_margin) END AS gm
  FROM fam f JOIN sup s ON f.entity = s.entity GROUP BY ALL) m ON f.quarter = m.quarter AND f.kind = m.kind AND f.sector = m.sector""", "fam", "sup")
def _(s, d):
    f = World(s, d).families().join(bind.entities(s, d).select("entity", "sector"), "entity")
    by = ["quarter", "kind", "sector"]
    return pn.growth_score(f, pn.group_medians(f, by, ["roa", "gross_margin"]), by, ["roa", "gross_margin"], F.col("ncfo") > F.col("netinc")).select(*KEY, "med_roa", "g_score")


_TIES = "(SELECT quarter, kind, unnest(['returned', 'lines']) AS \"column\", unnest([r, n]) AS value FROM (SELECT l_suppkey, date_trunc('quarter', l_shipdate)::DATE AS quarter, l_linestatus AS kind, (count(*) FILTER (l_returnflag = 'R'))::DOUBLE AS r, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL))"
_AUDIT = f"""SELECT "column", kind, sum(n)::BIGINT AS n_rows, count(DISTINCT quarter) AS n_partitions, count(DISTINCT value) AS n_values, count(*) AS n_pairs,
  round(coalesce(sum(n) FILTER (n > 1), 0)::DOUBLE / sum(n), 6) + 0.0::DOUBLE AS tie_mass, round(coalesce(sum(n) FILTER (n > 1 AND spread = 1), 0)::DOUBLE / sum(n), 6) + 0.0::DOUBLE AS keyed_mass,
  round(max(n::DOUBLE / size) FILTER (n > 1 AND spread = 1), 6) + 0.0::DOUBLE AS max_key_share
FROM (SELECT *, count(*) OVER (PARTITION BY "column", kind, value) AS spread, sum(n) OVER (PARTITION BY "column", kind, quarter) AS size FROM (SELECT "column", kind, quarter, value, count(*) AS n FROM {_TIES} GROUP BY ALL)) GROUP BY "column", kind"""


def _audit(s, d):
    g = bind.table(s, d, "lineitem").groupBy("l_suppkey", F.trunc("l_shipdate", "quarter").alias("quarter"), F.col("l_linestatus").alias("kind")).agg(F.count_if(F.col("l_returnflag") == "R").cast("double").alias("returned"), F.count("*").cast("double").alias("lines"))
    return pn.tie_audit(g, ["returned", "lines"], "quarter", "kind")


@query("tie_audit", _AUDIT)
def _(s, d):
    return _audit(s, d).drop("at_partition", "at_value")


@query("audit_gate", f'SELECT "column", max(max_key_share) AS worst, coalesce(max(max_key_share) > 0.02::DOUBLE, false) AS flagged FROM ({_AUDIT}) GROUP BY "column"')
def _(s, d):
    return pn.audit_gate(_audit(s, d))


_WEIGHTS = """SELECT w.entity, w.quarter, w.kind, w.date, w.h::BIGINT AS h, round(avg(1.0::DOUBLE / c.open), 6) + 0.0::DOUBLE AS weight FROM (SELECT * FROM obs WHERE observable) w
  JOIN (SELECT entity, h, day, count(*) AS open FROM (SELECT entity, h, unnest(generate_series(date, label_end, INTERVAL 1 DAY))::DATE AS day FROM obs WHERE observable) GROUP BY 1, 2, 3) c ON c.entity = w.entity AND c.h = w.h AND c.day BETWEEN w.date AND w.label_end GROUP BY w.entity, w.quarter, w.kind, w.date, w.h"""


def _weights(w, horizons: tuple[int, ...] = sn.HORIZONS):
    """Weights of these horizons from the snapshots of ``w``, which a query makes once and which lie by entity, so that nothing is shuffled."""
    o = w.observations(horizons).where("observable")
    return pn.uniqueness_weights(o, ["entity", "h"], "date", "label_end", [*KEY, "h"])


query("uniqueness_weights", _WEIGHTS, "obs")(lambda s, d: _weights(World(s, d)))


@query("effective_sample", f"SELECT kind, h, count(*) AS n, round(sum(weight), 3) + 0.0::DOUBLE AS effective FROM ({_WEIGHTS}) GROUP BY kind, h", "obs")
def _(s, d):
    return _weights(World(s, d)).groupBy("kind", "h").agg(F.count("*").alias("n"), F.round(F.sum(F.round("weight", 6)), 3).alias("effective"))


@query("assembled_panel", f"""SELECT f.entity, f.quarter, f.kind, f.date, round(f.sales_yield, 6) + 0.0::DOUBLE AS sales_yield, round(f.roa, 6) + 0.0::DOUBLE AS roa, round(l.cagr, 6) + 0.0::DOUBLE AS cagr, w.weight
FROM fam f LEFT JOIN (SELECT * FROM lab WHERE h = 1) l ON f.entity = l.entity AND f.quarter = l.quarter AND f.kind = l.kind LEFT JOIN (SELECT * FROM ({_WEIGHTS}) WHERE h = 1) w ON f.entity = w.entity AND f.quarter = w.quarter AND f.kind = w.kind""", "fam", "lab", "obs")
def _(s, d):
    from tidemark.plans.assemble import assemble

    w = World(s, d)
    return assemble(w.families().select(*KEY, "sales_yield", "roa"), w.labels(horizons=(1,)).select("entity", "quarter", "kind", "cagr"), _weights(w, (1,)))


# -- splits -------------------------------------------------------------------------------------------------


@query("fold_calendar", "SELECT scheme, fold::BIGINT AS fold, h::BIGINT AS h, test_start, test_end, 30::BIGINT AS embargo_days FROM folds", "folds")
def _(s, d):
    return pn.fold_calendar(World(s, d).observations())


def _tags(s, d):
    o = World(s, d).observations()
    f = pn.fold_calendar(o)
    return f, pn.tag_roles(o, f)


@query("role_tags", f"SELECT scheme, fold::BIGINT AS fold, h::BIGINT AS h, {_K}, role FROM tags", "tags")
def _(s, d):
    return _tags(s, d)[1].select("scheme", "fold", "h", *KEY, "role")


@query("fold_manifest", "SELECT f.scheme, f.fold::BIGINT AS fold, f.h::BIGINT AS h, f.test_start, f.test_end, 30::BIGINT AS embargo_days, " + ", ".join(f"count(*) FILTER (t.role = '{r}') AS n_{r}" for r in ("train", "test", "purged", "embargoed")) + " FROM folds f LEFT JOIN tags t ON f.scheme = t.scheme AND f.fold = t.fold AND f.h = t.h GROUP BY f.scheme, f.fold, f.h, f.test_start, f.test_end", "folds", "tags")
def _(s, d):
    return pn.fold_manifest(*_tags(s, d))


_BUCKET = "(('0x' || substr(md5({}), 1, 8))::BIGINT % 5)"


@query("entity_holdout", f"SELECT {_K}, CASE WHEN {_BUCKET.format('entity::VARCHAR')} = 0 THEN 'test' ELSE 'train' END AS role FROM snap WHERE date < DATE '2000-01-01'", "snap")
def _(s, d):
    return pn.hash_split(World(s, d).snaps, ["entity"], F.col("date") < F.lit("2000-01-01").cast("date")).select(*KEY, "role")


@query("random_kfold", f"SELECT {_K}, k.k::BIGINT AS fold, CASE WHEN {_BUCKET.format(chr(39).join(['entity::VARCHAR || ', '|', ' || quarter::VARCHAR || ', '|', ' || kind']))} = k.k THEN 'test' ELSE 'train' END AS role FROM snap CROSS JOIN (VALUES (0), (1), (2), (3), (4)) k(k) WHERE date < DATE '2000-01-01'", "snap")
def _(s, d):
    return pn.random_folds(World(s, d).snaps, ["entity", "quarter", "kind"], F.col("date") < F.lit("2000-01-01").cast("date")).select(*KEY, "fold", "role")


@query("training_rows", f"SELECT {_K} FROM snap s WHERE EXISTS (SELECT 1 FROM tags t WHERE t.scheme = 'holdout' AND t.h = 1 AND t.role = 'train' AND t.entity = s.entity AND t.quarter = s.quarter AND t.kind = s.kind)", "snap", "tags")
def _(s, d):
    w = World(s, d)
    t = _tags(s, d)[1].where("scheme = 'holdout' and h = 1 and role = 'train'")
    return w.snaps.join(t.select("entity", "quarter", "kind"), ["entity", "quarter", "kind"], "left_semi").select(*KEY)


# -- inference ----------------------------------------------------------------------------------------------

_AS_OF = "2000-06-30"


def _latest_sql(max_age: int, as_of: str | None = None) -> str:
    upto = f" WHERE date <= DATE '{as_of}'" if as_of else ""
    return f"(SELECT p.entity, date_trunc('quarter', m.d)::DATE AS quarter, 'inference' AS kind, p.date, p.entry, (m.ix - c.ix)::BIGINT AS age FROM (SELECT entity, max(date) AS date, max_by(close, date) AS entry FROM px{upto} GROUP BY entity) p JOIN cal c ON c.date = p.date CROSS JOIN (SELECT max(date) AS d, max(ix) AS ix FROM cal{upto}) m WHERE m.ix - c.ix <= {max_age})"


_LATEST = _latest_sql(60)


class AsOf(World):
    """The last prints at a date as snapshots, with filings of that very date known."""

    exact = True

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str | None = None, max_age: int = 5):
        super().__init__(spark, sf_dir)
        self.as_of, self.max_age = as_of, max_age

    @cached_property
    def snaps(self) -> DataFrame:
        return bucketed(sn.latest_snapshots(self.prices, self.calendar, self.max_age, self.as_of), ["entity"], dealt=True)

    @cached_property
    def known(self) -> DataFrame:
        return materialized(self.base(True))


@query("latest_snapshots", f"SELECT * FROM {_latest_sql(5)}", "px", "cal")
def _(s, d):
    return AsOf(s, d).snaps


@query("latest_snapshots_as_of", f"SELECT * FROM {_latest_sql(20, _AS_OF)}", "px", "cal")
def _(s, d):
    return AsOf(s, d, _AS_OF, 20).snaps


@query("inference_panel", f"SELECT s.entity, s.date, f.datekey, round(f.revenue / CASE WHEN s.entry * f.shares > 0 THEN s.entry * f.shares END, 6) + 0.0::DOUBLE AS sales_yield FROM {_LATEST} s ASOF LEFT JOIN fil1 f ON s.entity = f.entity AND s.date >= f.datekey", "px", "cal", "fil1")
def _(s, d):
    return fu.valuation(fu.market_inputs(AsOf(s, d, max_age=60).known)).select("entity", "date", "datekey", "sales_yield")


# -- reports ------------------------------------------------------------------------------------------------

_MED = "(SELECT b.*, s.sector, b.date - b.datekey AS age FROM base b JOIN sup s ON b.entity = s.entity WHERE b.kind = 'median')"


def _median_base(w):
    """Snapshots of the kind median with their filing and sector; only they meet filings."""
    base = fu.fund_base(w.snaps.where("kind = 'median'"), w.filings, [c for c in w.filings.columns if c not in ("entity", "datekey", "reportperiod")])
    return base.join(bind.entities(w.spark, w.dir).select("entity", "sector"), "entity").withColumn("age", F.datediff("date", "datekey"))


_RATES = ["with_filing", "fresh", "fresh_183", "fresh_365", "t1", "t2", "t3", "p12", "p36"]


def _coverage_sql(by: str) -> str:
    rates = ", ".join(f"round(avg(coalesce({c}, false)::INT), 6) + 0.0::DOUBLE AS {c}" for c in _RATES)
    lag = lambda k: f"coalesce(age <= 365, false) AND {' AND '.join(f'has_t{i}' for i in range(1, k + 1))} AS t{k}"
    return f"""SELECT {by}, count(*) AS n, round(median(age), 6) + 0.0::DOUBLE AS median_age, {rates} FROM (
  SELECT m.*, year(m.date)::BIGINT AS year, datekey IS NOT NULL AS with_filing, age <= 135 AS fresh, age <= 183 AS fresh_183, age <= 365 AS fresh_365, {lag(1)}, {lag(2)}, {lag(3)}, n_12m >= 40 AS p12, n_36m >= 120 AS p36
  FROM {_MED} m JOIN ({_LAG_FLAGS}) l USING (entity, quarter, kind, date) LEFT JOIN ({_PRINTS}) p USING (entity, quarter)) GROUP BY 1"""


def _coverage(s, d, by: str):
    """Rates of filings, freshness, lags (with a filing of 365 days or less) and prints by year or sector of the median snapshots."""
    w = World(s, d)
    med = materialized(w.known.where("kind = 'median'"))
    lags = fu.lag_presence(med, w.filings, KEY)
    rows = med.join(lags, KEY).join(_print_counts(w), ["entity", "quarter"], "left").join(bind.entities(s, d).select("entity", "sector"), "entity")
    rows = materialized(rows.withColumn("age", F.datediff("date", "datekey")).withColumn("year", F.year("date").cast("long")))
    c = F.col
    rates = {"with_filing": c("datekey").isNotNull(), "fresh": c("age") <= 135, "fresh_183": c("age") <= 183, "fresh_365": c("age") <= 365}
    ok = c("age") <= 365
    for k in (1, 2, 3):
        ok = ok & c(f"has_t{k}")
        rates[f"t{k}"] = ok
    return qr.coverage(rows, by, "age", rates | {"p12": c("n_12m") >= 40, "p36": c("n_36m") >= 120})


@query("history_presence", "SELECT b.entity, b.quarter, count(*) FILTER (p.date > b.date - 372) AS n_12m, count(*) AS n_36m FROM snap b JOIN px p ON p.entity = b.entity AND p.date > b.date - 1116 AND p.date <= b.date WHERE b.kind = 'median' GROUP BY b.entity, b.quarter", "snap", "px")
def _(s, d):
    return _print_counts(World(s, d))


def _print_counts(w) -> DataFrame:
    """Prints of the 12 and 36 months up to each median snapshot."""
    day = lambda c: F.datediff(c, F.lit("1990-01-01").cast("date"))
    a = w.snaps.where("kind = 'median'").select("entity", "quarter", day(F.col("date")).alias("s_day"))
    b = band_stats(a, w.prices.withColumn("day", day(F.col("date"))), ["entity"], "s_day", "day", {"print": F.lit(1)}, {"print": [372, 1116]})
    return a.join(b, ["entity", "s_day"]).where("print_n_1116 > 0").select("entity", "quarter", F.col("print_n_372").alias("n_12m"), F.col("print_n_1116").alias("n_36m"))


_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS field, year(date)::BIGINT AS year, sector, count(*) AS n, round(avg(({c} IS NULL)::INT), 6) + 0.0::DOUBLE AS null_rate FROM (SELECT f.*, s.sector FROM fam f JOIN sup s ON f.entity = s.entity) GROUP BY 2, 3" for c in ("earnings_yield", "ebit_to_ev", "revenue_growth_1y", "revenue_t3"))


def _null_rates(s, d):
    f = World(s, d).families().join(bind.entities(s, d).select("entity", "sector"), "entity").withColumn("year", F.year("date"))
    return qr.null_rates(f, ["year", "sector"], ["earnings_yield", "ebit_to_ev", "revenue_growth_1y", "revenue_t3"])


query("null_rates", _NULLS, "fam", "sup")(_null_rates)


@query("top_null_rates", "SELECT field, rate FROM (SELECT field, round(sum(n * null_rate) / sum(n), 4) + 0.0::DOUBLE AS rate FROM (" + _NULLS + ") GROUP BY field) ORDER BY rate DESC, field LIMIT 15", "fam", "sup")
def _(s, d):
    return qr.top_null_rates(_null_rates(s, d)).withColumn("rate", F.round("rate", 4))


_BUCKETS = "CASE WHEN age IS NULL THEN 'none' WHEN age <= 45 THEN '000-045' WHEN age <= 90 THEN '046-090' WHEN age <= 135 THEN '091-135' WHEN age <= 180 THEN '136-180' WHEN age <= 400 THEN '181-400' ELSE '401-' END"


@query("staleness_buckets", f"SELECT bucket, n, round(flag, 6) + 0.0::DOUBLE AS flag_share, round(n::DOUBLE / sum(n) OVER (), 6) + 0.0::DOUBLE AS share FROM (SELECT {_BUCKETS} AS bucket, count(*) AS n, avg((round(l.cagr, 9) >= 0)::INT) AS flag FROM {_MED} m LEFT JOIN (SELECT * FROM lab WHERE h = 1) l ON m.entity = l.entity AND m.quarter = l.quarter AND m.kind = l.kind GROUP BY 1)", "base", "sup", "lab")
def _(s, d):
    w = World(s, d)
    lab = w.flagged((1,), ("median",)).select("entity", "quarter", "kind", F.col("cagr_ge_0").alias("gain"))
    return qr.staleness_buckets(_median_base(w).join(lab, ["entity", "quarter", "kind"], "left"), "age", "gain")


@query("staleness_by_year", f"SELECT year, fresh, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY year), 6) + 0.0::DOUBLE AS share FROM (SELECT year(date)::BIGINT AS year, coalesce(age <= 135, false) AS fresh, count(*) AS n FROM {_MED} GROUP BY 1, 2)", "base", "sup")
def _(s, d):
    return qr.staleness_by_year(_median_base(World(s, d)), "age", "date")


@query("update_lag", "SELECT year(o_orderdate)::BIGINT AS year, count(lag) AS n, round(median(lag), 6) + 0.0::DOUBLE AS median_lag, round(quantile_cont(lag, 0.95), 6) + 0.0::DOUBLE AS p95_lag, round(avg((lag > 35)::INT), 6) + 0.0::DOUBLE AS share_late FROM (SELECT o.o_orderdate, l.l_shipdate::DATE - o.o_orderdate::DATE AS lag FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) GROUP BY 1")
def _(s, d):
    j = bind.table(s, d, "orders").join(bind.table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return qr.update_lag(j, F.datediff("l_shipdate", "o_orderdate"), F.year("o_orderdate"))


@query("md5_sample", "SELECT o_custkey, o_orderkey FROM orders ORDER BY md5(o_custkey::VARCHAR || '|' || o_orderkey::VARCHAR), o_custkey, o_orderkey LIMIT 50")
def _(s, d):
    return qr.md5_sample(bind.table(s, d, "orders").select("o_custkey", "o_orderkey"), 50, "o_custkey", "o_orderkey")


_REPL = "(SELECT o_totalprice AS reported, sum(l_extendedprice) AS computed, sum(l_extendedprice * (1 - l_discount)) AS latest FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice)"


def _reported(s, d):
    j = bind.table(s, d, "orders").join(bind.table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderkey", F.col("o_totalprice").alias("reported")).agg(F.sum("l_extendedprice").alias("computed"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("latest"))


@query("replication_error", f"SELECT round(s, 6) + 0.0::DOUBLE AS scale, count(*) AS n, round(median(e), 6) + 0.0::DOUBLE AS median_err, round(quantile_cont(e, 0.9), 6) + 0.0::DOUBLE AS p90_err, round(avg((e <= 0.01::DOUBLE)::INT), 6) + 0.0::DOUBLE AS within_1pct, round(avg((e <= 0.05::DOUBLE)::INT), 6) + 0.0::DOUBLE AS within_5pct FROM (SELECT s, abs(reported / (computed * s) - 1) AS e FROM {_REPL} CROSS JOIN (SELECT median(reported / computed) AS s FROM {_REPL} WHERE reported > 0 AND computed > 0) WHERE reported > 0 AND computed > 0) GROUP BY s")
def _(s, d):
    return qr.replication_error(_reported(s, d), "reported", "computed")


@query("source_discrimination", f"SELECT count(*) AS n, count(*) FILTER (abs(ln(reported / computed)) < abs(ln(reported / latest))) AS first_nearer, count(*) FILTER (abs(ln(reported / computed)) > abs(ln(reported / latest))) AS latest_nearer FROM {_REPL} WHERE reported > 0 AND computed > 0 AND latest > 0 AND abs(computed / latest - 1) > 0.01::DOUBLE")
def _(s, d):
    return qr.source_discrimination(_reported(s, d), "reported", "computed", "latest")


_LONG = " UNION ALL ".join(f"SELECT entity, quarter, '{c}' AS feature, {c}::DOUBLE AS value FROM fam WHERE {c} IS NOT NULL" for c in ("sales_yield", "roa", "gross_margin"))


@query("intra_group_variation", f"SELECT feature, count(*) AS n_groups, round(avg((hi > lo)::INT), 6) + 0.0::DOUBLE AS share_differ, round(median((hi - lo) / nullif(abs(mid), 0)), 6) + 0.0::DOUBLE AS median_range FROM (SELECT entity, quarter, feature, count(*) AS n, max(value) AS hi, min(value) AS lo, quantile_disc(value, 0.5) AS mid FROM ({_LONG}) GROUP BY ALL HAVING count(*) >= 2) GROUP BY feature", "fam")
def _(s, d):
    f = World(s, d).families()
    return qr.intra_group_variation(qr.long_form(f, ["entity", "quarter"], ["sales_yield", "roa", "gross_margin"]), ["entity", "quarter"])


@query("filing_straddle", "SELECT count(*) AS n_groups, count(*) FILTER (k > 1) AS n_straddle, round((count(*) FILTER (k > 1))::DOUBLE / count(*), 6) + 0.0::DOUBLE AS share FROM (SELECT entity, quarter, count(DISTINCT coalesce(datekey::VARCHAR, 'none')) AS k FROM base GROUP BY 1, 2)", "base")
def _(s, d):
    return qr.straddle(World(s, d).base(), ["entity", "quarter"], "datekey")


_FLIPS = [f"{c}_{h}y" for h in sn.HORIZONS for c in LADDER] + ["never_1y"]
_FLIP_VALUES = ", ".join(f"h = {h} AND {c}" if c != "never" else "NULL::BOOLEAN" for c, h in (x.rsplit("_", 1) for x in [f"{c}_{h}" for h in sn.HORIZONS for c in LADDER] + ["never_1"]))
_FLIP_KNOWN = ", ".join(f"h = {h}" for h in sn.HORIZONS for _ in LADDER) + ", false"


@query("flip_rates", f"""SELECT flag, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS n_groups, count(*) FILTER (a <> b) AS n_flips, round((count(*) FILTER (a <> b))::DOUBLE / nullif(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL), 0), 6) + 0.0::DOUBLE AS rate FROM (
  SELECT flag, entity, quarter, bool_or(v) FILTER (kind = 'low' AND known) AS a, bool_or(v) FILTER (kind = 'high' AND known) AS b FROM (
    SELECT entity, quarter, kind, unnest([{', '.join(repr(x) for x in _FLIPS)}]) AS flag, unnest([{_FLIP_VALUES}]) AS v, unnest([{_FLIP_KNOWN}]) AS known FROM labx) GROUP BY flag, entity, quarter) GROUP BY flag""", "labx")
def _(s, d):
    cols = [F.when(F.col("h") == h, F.col(c)).alias(f"{c}_{h}y") for h in sn.HORIZONS for c in LADDER]
    lab = World(s, d).flagged().select("entity", "quarter", "kind", *cols, F.lit(None).cast("boolean").alias("never_1y"))
    return qr.flip_rates(lab, ["entity", "quarter"], "kind", "low", "high", _FLIPS)


@query("variance_decomposition", f"SELECT feature, sum(n)::BIGINT AS n, round(sum(n * v) / (sum(n * v) + sum(n * (m - g) * (m - g))), 6) + 0.0::DOUBLE AS within_share FROM (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS g FROM (SELECT feature, entity, quarter, count(*) AS n, var_pop(value) AS v, avg(value) AS m FROM ({_LONG}) GROUP BY ALL)) GROUP BY feature", "fam")
def _(s, d):
    return qr.variance_decomposition(World(s, d).families(), ["entity", "quarter"], ["sales_yield", "roa", "gross_margin"])


@query("serial_corr", "SELECT k.k::BIGINT AS lag, count(*) AS n, round(corr(a.cagr, b.cagr), 6) + 0.0::DOUBLE AS corr FROM (SELECT * FROM lab WHERE h = 1 AND kind = 'median') a CROSS JOIN (VALUES (1), (2), (4), (8)) k(k) JOIN (SELECT * FROM lab WHERE h = 1 AND kind = 'median') b ON a.entity = b.entity AND b.quarter = (a.quarter + to_months(3 * k.k))::DATE GROUP BY 1", "lab")
def _(s, d):
    return qr.serial_correlation(World(s, d).labels(horizons=(1,), kinds=("median",)), "entity", "quarter", "cagr", [1, 2, 4, 8])


_SPACE = "(SELECT entity, quarter, sales_yield AS x, roa AS y, gross_margin AS z FROM fam WHERE kind = 'median' AND sales_yield IS NOT NULL AND roa IS NOT NULL AND gross_margin IS NOT NULL)"


def _space(s, d):
    return World(s, d).families().where("kind = 'median' and sales_yield is not null and roa is not null and gross_margin is not null").select("entity", "quarter", F.col("sales_yield").alias("x"), F.col("roa").alias("y"), F.col("gross_margin").alias("z"))


@query("nearest_twin", f"""SELECT s_e, s_q, t_e, t_q, round(d2, 6) + 0.0::DOUBLE AS d2, CASE WHEN t_e = s_e AND gap <= 12 THEN 'same entity, near' WHEN t_e = s_e THEN 'same entity, far' WHEN t_q = s_q THEN 'same quarter' ELSE 'other' END AS relation FROM (
  SELECT *, abs(12 * (year(s_q) - year(t_q)) + month(s_q) - month(t_q)) AS gap, row_number() OVER (PARTITION BY s_e, s_q ORDER BY d2, t_e, t_q) AS rn FROM (
    SELECT a.entity AS s_e, a.quarter AS s_q, b.entity AS t_e, b.quarter AS t_q, round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 9) AS d2
    FROM (SELECT * FROM {_SPACE} ORDER BY md5(entity::VARCHAR || '|' || quarter::VARCHAR), entity, quarter LIMIT 200) a JOIN {_SPACE} b ON a.entity <> b.entity OR a.quarter <> b.quarter)) WHERE rn = 1""", "fam")
def _(s, d):
    sp = materialized(_space(s, d))  # read by the sample and by the search
    return qr.nearest_neighbours(sp, qr.md5_sample(sp, 200, "entity", "quarter"), ["x", "y", "z"], "entity", "quarter")


@query("random_partners", """WITH t AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS rn, count(*) OVER () AS n FROM (SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 500))
SELECT a.o_orderkey, b.o_orderkey AS p_o_orderkey FROM t a JOIN t b ON b.rn = 1 + ('0x' || substr(md5('p|' || a.o_orderkey::VARCHAR), 1, 8))::BIGINT % a.n""")
def _(s, d):
    return qr.random_partners(qr.md5_sample(bind.table(s, d, "orders").select("o_orderkey"), 500, "o_orderkey"), ["o_orderkey"])


@query("purge_cost", "SELECT b.b AS boundary, h.h::BIGINT AS h, count(*) FILTER (date < b.b) AS n_before, count(*) FILTER (date < b.b AND (date + to_years(h.h))::DATE + 30 < b.b) AS n_train, count(*) FILTER (date < b.b AND NOT (date + to_years(h.h))::DATE + 30 < b.b) AS n_purged, count(*) FILTER (date >= b.b) AS n_after FROM snap CROSS JOIN (SELECT make_date(y, 1, 1) AS b FROM unnest(generate_series((SELECT min(year(date)) + 2 FROM snap), (SELECT max(year(date)) FROM snap))) t(y)) b CROSS JOIN (VALUES (1), (2), (3), (5)) h(h) GROUP BY 1, 2", "snap")
def _(s, d):
    w = World(s, d)
    years = w.snaps.agg(F.min(F.year("date")).alias("lo"), F.max(F.year("date")).alias("hi")).where("lo + 2 <= hi").select(F.explode(F.sequence(F.col("lo") + 2, F.col("hi"))).alias("y"))
    return qr.purge_cost(w.snaps, years.select(F.make_date("y", F.lit(1), F.lit(1)).alias("boundary")), sn.HORIZONS)


# -- whole families over all fields -------------------------------------------------------------------------


def _full_family(name: str):
    return lambda s, d: fu.family(wide.Features(World(s, d)).inputs, name, KEY)


def _full_sql(name: str) -> str:
    out = []
    for c, e in fam.FAMILIES[name].items():
        if c == "piotroski_f":
            out.append(f"CAST({e} AS BIGINT) AS {c}")
        elif c.startswith("piotroski_") or c in ("two_year_loss", "liab_gt_assets"):
            out.append(f"{e} AS {c}")
        else:
            out.append(f"round(CAST({e} AS DOUBLE), 6) + 0.0::DOUBLE AS {c}")
    return f"SELECT {_K}, {', '.join(out)} FROM full_x"


for _name in fam.FAMILIES:
    query(f"family_{_name}", _full_sql(_name), "full_x")(_full_family(_name))


# -- more reports -------------------------------------------------------------------------------------------

_LAG_FLAGS = f"SELECT b.entity, b.quarter, b.kind, b.date, b.datekey IS NOT NULL AS has_t0, {', '.join(f'coalesce(p.has_t{k}, false) AS has_t{k}' for k in (1, 2, 3))} FROM base b LEFT JOIN (SELECT {_K}, {', '.join(f'bool_or(abs(gap - {k} * 365) <= 30) AS has_t{k}' for k in (1, 2, 3))} FROM known GROUP BY {_K}) p USING (entity, quarter, kind, date)"
_PRINTS = "SELECT b.entity, b.quarter, count(*) FILTER (p.date > b.date - 372) AS n_12m, count(*) AS n_36m FROM snap b JOIN px p ON p.entity = b.entity AND p.date > b.date - 1116 AND p.date <= b.date WHERE b.kind = 'median' GROUP BY b.entity, b.quarter"


@query("lag_presence", _LAG_FLAGS, "base", "known")
def _(s, d):
    w = World(s, d)
    return fu.lag_presence(w.known, w.filings, KEY)


for _by in ("year", "sector"):
    query(f"coverage_by_{_by}", _coverage_sql(_by), "base", "sup", "known", "snap", "px")(lambda s, d, by=_by: _coverage(s, d, by))


@query("tier_coverage", f"SELECT l.entity, l.quarter, has_t0 AS t0, has_t0 AND has_t1 AS t1, has_t0 AND has_t1 AND has_t2 AS t2, has_t0 AND has_t1 AND has_t2 AND has_t3 AS t3, coalesce(n_12m >= 40, false) AS p12, coalesce(n_36m >= 120, false) AS p36 FROM ({_LAG_FLAGS}) l LEFT JOIN ({_PRINTS}) p USING (entity, quarter) WHERE kind = 'median'", "base", "known", "snap", "px")
def _(s, d):
    w = World(s, d)
    flags = fu.lag_presence(w.known.where("kind = 'median'"), w.filings, KEY).join(_print_counts(w), ["entity", "quarter"], "left")
    return qr.tier_flags(flags, 40, 120).select("entity", "quarter", "t0", "t1", "t2", "t3", "p12", "p36")


_DIMENSIONS = "(SELECT entity, datekey, reportperiod, CASE WHEN f = 1 THEN 'ARQ' ELSE 'MRQ' END AS dimension, rev * f AS revenue FROM fv)"
_NEWEST = f"(SELECT entity, datekey, reportperiod, dimension, revenue FROM (SELECT *, row_number() OVER (PARTITION BY dimension, entity, datekey ORDER BY reportperiod DESC) AS rn FROM {_DIMENSIONS}) WHERE rn = 1)"


def _dimensions(w) -> DataFrame:
    f = bind.full_filings(w.spark, w.dir, keep=["f"])
    return f.select("entity", "datekey", "reportperiod", F.when(F.col("f") == 1, "ARQ").otherwise("MRQ").alias("dimension"), "revenue")


@query("newest_by_dimension", f"SELECT entity, datekey, reportperiod, dimension, round(revenue, 6) + 0.0::DOUBLE AS revenue FROM {_NEWEST}", "fv")
def _(s, d):
    return qr.newest_by_dimension(_dimensions(World(s, d)), ("ARQ", "MRQ"))


@query("two_sided_base", f"SELECT p.entity, p.date, a.datekey AS datekey_arq, round(a.revenue, 6) + 0.0::DOUBLE AS revenue_arq, m.datekey AS datekey_mrq, round(m.revenue, 6) + 0.0::DOUBLE AS revenue_mrq FROM px p ASOF JOIN (SELECT * FROM {_NEWEST} WHERE dimension = 'ARQ') a ON p.entity = a.entity AND p.date > a.datekey ASOF LEFT JOIN (SELECT * FROM {_NEWEST} WHERE dimension = 'MRQ') m ON p.entity = m.entity AND p.date > m.datekey", "px", "fv")
def _(s, d):
    w = World(s, d)
    f = materialized(qr.newest_by_dimension(_dimensions(w), ("ARQ", "MRQ")))
    return qr.two_sided(w.prices.select("entity", "date"), f, "ARQ", "MRQ", "revenue")


@query("levels_with_flows", "SELECT entity, datekey, reportperiod, round(assets, 6) + 0.0::DOUBLE AS assets, round(debt, 6) + 0.0::DOUBLE AS debt, round(CASE WHEN lines > 3 THEN revenue END, 6) + 0.0::DOUBLE AS revenue, round(CASE WHEN lines > 3 THEN ncfo END, 6) + 0.0::DOUBLE AS ncfo FROM (SELECT f.*, v.lines FROM fullf f JOIN fv v USING (entity, datekey, reportperiod))", "fullf", "fv")
def _(s, d):
    """Quarter rows (ARQ) hold levels, rows of the same key (ART) flows; the latter are missing where a quarter has few lines."""
    f = bind.full_filings(s, d, keep=["lines"]).select("entity", "datekey", "reportperiod", "assets", "debt", "revenue", "ncfo", "lines")
    rows = f.withColumn("dimension", F.explode(F.when(F.col("lines") > 3, F.array(F.lit("ARQ"), F.lit("ART"))).otherwise(F.array(F.lit("ARQ")))))
    return fu.levels_with_flows(rows, "ARQ", "ART", ["assets", "debt"], ["revenue", "ncfo"])


@query("lag_verdict", "SELECT sum(n)::BIGINT AS n, round(sum(share_late * n) / sum(n), 6) + 0.0::DOUBLE AS share_late FROM (SELECT count(lag) AS n, avg((lag > 35)::INT) AS share_late FROM (SELECT o.o_orderdate, l.l_shipdate::DATE - o.o_orderdate::DATE AS lag FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) GROUP BY year(o_orderdate))")
def _(s, d):
    j = bind.table(s, d, "orders").join(bind.table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return qr.weighted_share(qr.update_lag(j, F.datediff("l_shipdate", "o_orderdate"), F.year("o_orderdate")), "share_late", "n")


# -- the wide panel -----------------------------------------------------------------------------------------

_META = f"""SELECT {_K}, datekey AS fund_datekey, reportperiod AS fund_reportperiod, (date - datekey)::BIGINT AS fundamentals_age_days, coalesce(date - datekey <= 183, false) AS has_filing_183d, coalesce(date - datekey <= 365, false) AS has_filing_365d,
  equity <= 0 AS negative_equity, ebitda <= 0 AS negative_ebitda, CASE WHEN entry * sharesbas * sharefactor > 0 THEN entry * sharesbas * sharefactor END + debt - cashneq <= 0 AS negative_ev FROM fullb"""


@query("meta_family", _META, "fullb")
def _(s, d):
    return wide.Features(World(s, d)).meta()


_DIVIDENDS = f"""SELECT {_K}, count(*) FILTER (div > 0) AS div_years_paid_10y, count(*) FILTER (ok) AS div_streak_10y, count(*) FILTER (prev_div > 0 AND div < 0.8::DOUBLE * prev_div) AS div_cuts_10y, count(div) AS div_history_years_10y FROM (
  SELECT *, bool_and(div > 0 AND off = rn2 - 1) OVER (PARTITION BY {_K} ORDER BY off ROWS UNBOUNDED PRECEDING) AS ok FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY off) AS rn2 FROM fulld)) GROUP BY {_K}"""


@query("dividend_family", _DIVIDENDS, "fulld")
def _(s, d):
    return wide.Features(World(s, d)).dividends()


_CLASSES = "SELECT entity, sector, industry, industry AS famaindustry, category AS scalemarketcap, code::BIGINT AS siccode FROM sup"


def _wide_sql(instead=None) -> str:
    """All families side by side, each by its own SQL, in the registry's order."""
    of = lambda name: sql(RECIPES[name][0], *RECIPES[name][1], instead=instead)
    names = ["meta_family", *[f"family_{n}" for n in fam.FAMILIES], "trend_family", "dividend_family", "relvalue_features", "technical_features_sparse"]
    joins = " ".join(f"LEFT JOIN ({of(n)}) f{i} USING (entity, quarter, kind, date)" for i, n in enumerate(names) if i)
    return f"SELECT {_K}, {', '.join(reg.columns(late=False))} FROM ({of(names[0])}) f0 {joins} LEFT JOIN ({sql(_CLASSES, 'sup')}) c USING (entity)"


def _features(s, d) -> wide.Features:
    """Features with the least observations that suit the few prints of the test tables."""
    return wide.Features(World(s, d), wide.SPARSE)


_LABELS = [f"{c}_{h}y" for h in sn.HORIZONS for c in _WIDE_LABEL]


def _full_panel(s, d):
    w = World(s, d)
    # written once, where features are made
    panel = bucketed(wide.as_stored(wide.Features(w, wide.SPARSE).all()), ["entity"], dealt=True)
    labels = w.wide_labels().select("entity", "quarter", "kind", "n_days", "entry", *_LABELS)
    return wide.full_panel(panel, wide.ranks(panel), labels, _weights(w), sn.HORIZONS)


def _twin_report(s, d):
    w = World(s, d)
    sp = materialized(wide.rank_space(wide.rounded(wide.Features(w, wide.SPARSE).all(wide.AXES))))
    sample = materialized(qr.md5_sample(sp, 200, "entity", "quarter"))
    near = qr.nearest_neighbours(sp, sample, wide.AXES, "entity", "quarter")
    other = qr.random_partners(sample.select("entity", "quarter"), ["entity", "quarter"]).select(F.col("entity").alias("s_e"), F.col("quarter").alias("s_q"), F.col("p_entity").alias("t_e"), F.col("p_quarter").alias("t_q"))
    return qr.twin_report(near, other, materialized(w.labels(horizons=(1,), kinds=("median",)).select("entity", "quarter", "cagr")), "cagr")


def _ranked_features(s, d):
    """What ``panel_ranks`` ranks, as it is stored."""
    return wide.as_stored(_features(s, d).all(list(reg.rank_specs())))


def _rank_audit(s, d):
    return pn.rank_audit(_ranked_features(s, d), reg.rank_specs(), "quarter", "kind")


def _register_wide() -> None:
    wide_sql = _wide_sql()
    query("wide_panel", wide_sql)(lambda s, d: _features(s, d).all())
    query("panel_ranks", _ranked_sql(reg.rank_specs(), "quarter, kind", f"({wide_sql})"))(lambda s, d: wide.ranks(_ranked_features(s, d)))
    query("panel_sector_ranks", _ranked_sql(reg.sector_specs(), "quarter, kind, sector", f"({wide_sql})"))(lambda s, d: wide.sector_ranks(wide.as_stored(_features(s, d).all(["sector", *reg.sector_specs()]))))
    used = {c: reg.rank_specs()[c] for c in ("vol_36m", "mom_12_2", "net_payout_yield", "ebit_to_ev", "roc_greenblatt")}
    first = _ranked_sql(used, "quarter, kind", f"({wide_sql})")
    scores = f"SELECT {_K}, round((1 - vol_36m_rank) + mom_12_2_rank + net_payout_yield_rank, 9) AS conservative_score, round(ebit_to_ev_rank + roc_greenblatt_rank, 9) AS magic_formula_score FROM ({first})"
    both = f"SELECT * FROM ({scores}) x JOIN ({_ranked_sql(dict.fromkeys(['conservative_score', 'magic_formula_score']), 'quarter, kind', f'({scores})')}) y USING (entity, quarter, kind, date)"
    query("panel_composites", f"SELECT {_K}, {r6('conservative_score', 'magic_formula_score')}, conservative_score_rank, magic_formula_score_rank FROM ({both})")(lambda s, d: wide.composites(wide.ranks(wide.as_stored(_features(s, d).all(list(used))), list(used))))
    med = ", ".join(f"CASE WHEN count({c}) >= 5 THEN median({c}) END AS m_{c}" for c in wide.MOHANRAM)
    beats = " + ".join(f"(w.{c} {'>' if up else '<'} m.m_{c})::INT" for c, up in wide.MOHANRAM.items())
    query("mohanram_g7", f"SELECT w.entity, w.quarter, w.kind, w.date, ({beats} + (w.cfo_to_assets > w.roa)::INT)::BIGINT AS mohanram_g7 FROM ({wide_sql}) w LEFT JOIN (SELECT quarter, kind, famaindustry, {med} FROM ({wide_sql}) GROUP BY ALL) m ON w.quarter = m.quarter AND w.kind = m.kind AND w.famaindustry = m.famaindustry")(lambda s, d: wide.mohanram(wide.rounded(_features(s, d).all(["famaindustry", *wide.MOHANRAM]))))
    ranks = _ranked_sql(reg.rank_specs(), "quarter, kind", f"({wide_sql})")
    names = [f"{c}_rank" for c in reg.rank_specs()]
    long = f"(SELECT quarter, kind, unnest([{', '.join(repr(n) for n in names)}]) AS \"column\", unnest([{', '.join(names)}]) AS value FROM ({ranks}))"
    audit = _AUDIT.replace(_TIES, f"(SELECT * FROM {long} WHERE value IS NOT NULL)")
    query("panel_rank_audit", audit)(lambda s, d: _rank_audit(s, d).drop("at_partition", "at_value"))
    query("panel_audit_gate", f'SELECT "column", max(max_key_share) AS worst, coalesce(max(max_key_share) > 0.02::DOUBLE, false) AS flagged FROM ({audit}) GROUP BY "column"')(lambda s, d: pn.audit_gate(_rank_audit(s, d)))

    query("audit_summary", f'SELECT "column", max(tie_mass) AS tie_mass, max(keyed_mass) AS keyed_mass, max(max_key_share) AS max_key_share, coalesce(max(max_key_share) > 0.02::DOUBLE, false) AS flagged FROM ({audit}) GROUP BY "column"')(lambda s, d: pn.audit_summary(_rank_audit(s, d)))
    raw = [n.removesuffix("_rank") for n in names]
    both_long = f"(SELECT quarter, kind, unnest([{', '.join(repr(n) for n in names)}]) AS \"column\", unnest([{', '.join(names)}]) AS value, unnest([{', '.join(f'{x}::DOUBLE' for x in raw)}]) AS raw FROM ({ranks}) r JOIN ({wide_sql}) x USING ({_K}))"
    query("audit_detail", f"""SELECT "column", kind, place, round(share, 6) + 0.0::DOUBLE AS share, key_partition, key_rank, round(raw, 6) + 0.0::DOUBLE AS key_raw FROM (
  SELECT "column", kind, quarter AS key_partition, value AS key_rank, raw, n::DOUBLE / size AS share, row_number() OVER (PARTITION BY "column", kind ORDER BY n::DOUBLE / size DESC, quarter DESC, value DESC) AS place, max(n::DOUBLE / size) OVER (PARTITION BY "column", kind) AS worst FROM (
    SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY "column", kind, value) AS spread, sum(n) OVER (PARTITION BY "column", kind, quarter) AS size FROM (SELECT "column", kind, quarter, value, count(*) AS n, min(raw) AS raw FROM {both_long} WHERE value IS NOT NULL GROUP BY ALL)) WHERE n > 1 AND spread = 1))
WHERE place <= 3 AND worst > 0.02::DOUBLE""")(lambda s, d: pn.rank_audit_detail(_ranked_features(s, d), reg.rank_specs(), "quarter", "kind", k=3))
    labelled = ", ".join(f"l.{c}" for c in ("n_days", "entry", *_LABELS))
    weighted = ", ".join(f"max(weight) FILTER (h = {h}) AS weight_{h}y" for h in sn.HORIZONS)
    query("full_panel", f"""SELECT w.*, r.* EXCLUDE ({_K}), {labelled}, {', '.join(f'u.weight_{h}y' for h in sn.HORIZONS)} FROM ({wide_sql}) w JOIN ({ranks}) r ON r.entity = w.entity AND r.quarter = w.quarter AND r.kind = w.kind
LEFT JOIN ({sql(_LABEL_WIDE, 'snap', 'labx', 'ends', 'px')}) l ON l.entity = w.entity AND l.quarter = w.quarter AND l.kind = w.kind
LEFT JOIN (SELECT entity, quarter, kind, {weighted} FROM ({sql(_WEIGHTS, 'obs')}) GROUP BY ALL) u ON u.entity = w.entity AND u.quarter = w.quarter AND u.kind = w.kind""")(_full_panel)

    axes = wide.AXES
    rank = ", ".join(f"round(percent_rank() OVER (PARTITION BY quarter ORDER BY {c}), 9) AS {c}" for c in axes)
    space = f"SELECT entity, quarter, {rank} FROM ({wide_sql}) WHERE kind = 'median' AND {' AND '.join(f'{c} IS NOT NULL' for c in axes)}"
    query("rank_space", space)(lambda s, d: wide.rank_space(wide.rounded(_features(s, d).all(wide.AXES))))
    away = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in axes)
    gap = "abs(12 * (year(s_q) - year(t_q)) + month(s_q) - month(t_q))"
    lab = sql("SELECT entity, quarter, cagr FROM lab WHERE h = 1 AND kind = 'median'", "lab")
    query("twin_report", f"""WITH space AS MATERIALIZED ({space}), picked AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5(entity::VARCHAR || '|' || quarter::VARCHAR), entity, quarter) AS rn, count(*) OVER () AS n FROM (SELECT * FROM space ORDER BY md5(entity::VARCHAR || '|' || quarter::VARCHAR), entity, quarter LIMIT 200)),
near AS (SELECT s_e, s_q, t_e, t_q, CASE WHEN t_e = s_e AND {gap} <= 12 THEN 'same entity, near' WHEN t_e = s_e THEN 'same entity, far' WHEN t_q = s_q THEN 'same quarter' ELSE 'other' END AS relation FROM (
  SELECT *, row_number() OVER (PARTITION BY s_e, s_q ORDER BY d2, t_e, t_q) AS k FROM (SELECT a.entity AS s_e, a.quarter AS s_q, b.entity AS t_e, b.quarter AS t_q, round({away}, 9) AS d2 FROM picked a JOIN space b ON a.entity <> b.entity OR a.quarter <> b.quarter)) WHERE k = 1),
pairs AS (SELECT * FROM near UNION ALL SELECT a.entity, a.quarter, b.entity, b.quarter, 'random' FROM picked a JOIN picked b ON b.rn = 1 + ('0x' || substr(md5('p|' || a.entity::VARCHAR || '|' || a.quarter::VARCHAR), 1, 8))::BIGINT % a.n),
lab1 AS MATERIALIZED ({lab}), met AS (SELECT p.relation, a.cagr AS x, b.cagr AS y FROM pairs p LEFT JOIN lab1 a ON a.entity = s_e AND a.quarter = s_q LEFT JOIN lab1 b ON b.entity = t_e AND b.quarter = t_q)
SELECT relation, n, n_labelled, round(c, 6) + 0.0::DOUBLE AS corr, round(m, 6) + 0.0::DOUBLE AS mean_abs_diff, round(n::DOUBLE / sum(n) OVER (PARTITION BY relation = 'random'), 6) + 0.0::DOUBLE AS share FROM (
  SELECT relation, count(*) AS n, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n_labelled, covar_pop(x, y) / nullif(stddev_pop(x) FILTER (y IS NOT NULL) * stddev_pop(y) FILTER (x IS NOT NULL), 0) AS c, avg(abs(x - y)) AS m FROM met GROUP BY relation)""")(_twin_report)
    now = _wide_sql(filed_on_the_day((["px", "cal"], f"SELECT entity, quarter, 1::BIGINT AS n_days, kind, entry, date FROM {_latest_sql(60, _AS_OF)}")))
    query("inference_features", now)(lambda s, d: wide.Features(AsOf(s, d, _AS_OF, 60), wide.SPARSE).all())
    query("inference_ranks", _ranked_sql(reg.rank_specs(), "quarter, kind", f"({now})"))(lambda s, d: wide.ranks(wide.as_stored(wide.Features(AsOf(s, d, _AS_OF, 60), wide.SPARSE).all(list(reg.rank_specs())))))


_register_wide()
