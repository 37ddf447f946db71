"""The wide panel: all feature families of one set of snapshots, ranks, composites, the growth score."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.functions import registry as reg
from tidemark.functions.exprs import round6, safe_ln
from tidemark.functions.families import FAMILIES, lagged_fields
from tidemark.operators import fundamentals as fu
from tidemark.operators import panel as pn
from tidemark.operators.asof import asof_join, join_dealt
from tidemark.operators.bitemporal import lagged_at_filing
from tidemark.sources import binding as bind
from tidemark.sources.io import bucketed, exact_columns, materialized

KEY = ["entity", "quarter", "kind", "date"]
SERIES = {"revenue": "revenue", "tangibles": "tangibles", "ncfo": "ocf"}
RATIOS = {"earnings_yield": "netinc", "ocf_yield": "ncfo", "fcf_yield": "fcf", "sales_yield": "revenue", "book_to_market": "equity", "tangible_book_to_market": "tangibles"}
SPARSE = {"year": 15, "three": 45, "five": 75, "month": 2}  # least observations where entities have few prints a year
MOHANRAM = {"roa": True, "cfo_to_assets": True, "roa_variability_3y": False, "revenue_growth_variability_3y": False, "rnd_to_assets": True, "capex_to_assets": True}  # above (or below) the group's median


AXES = ["earnings_yield", "sales_yield", "book_to_market", "ebit_to_ev", "gp_to_assets", "roa", "gross_margin", "net_margin", "asset_turnover", "current_ratio", "debt_to_equity", "log_assets"]  # of the rank space


def _cap(price: str):
    c = F.col(price) * F.col("sharesbas") * F.col("sharefactor")
    return F.when(c > 0, c)


def window_features(w, least: dict[str, int] | None = None) -> DataFrame:
    return fu.window_features(w.snaps, fu.price_ratios(w.prices, w.calendar), fu.benchmark_returns(bind.benchmark(w.spark, w.dir), w.calendar), w.calendar, least=least, dealt=True)


def technical(w, **least: int) -> DataFrame:
    """Window features and the logarithm of the market's value."""
    t = fu.fund_base(window_features(w, least), w.filings, ["shares"])
    return fu.market_cap(t).withColumn("log_marketcap", safe_ln(F.col("marketcap"))).select(*KEY, *reg.columns("technical", late=False), "n_obs")


class Features:
    """The families of the snapshots of ``w``.

    What depends on filings only is made once for each day on which an entity
    filed, and joined to the snapshots that look back on that day.  Prices,
    snapshots and filings are bucketed by entity and parts meet within it, so
    that no part is shuffled.
    """

    def __init__(self, w, least: dict[str, int] | None = None):
        self.w = w
        self.least = fu.TECHNICAL_LEAST if least is None else least  # observations that window features need

    @cached_property
    def filings(self) -> DataFrame:
        return bucketed(bind.full_filings(self.w.spark, self.w.dir).withColumn("div", -F.col("ncfdiv")), ["entity"], dealt=True)

    @property
    def base(self) -> DataFrame:
        """Snapshots with the day and period of their filing."""
        return fu.fund_base(self.w.snaps.select(*KEY, "entry"), self.filings.select("entity", "datekey", "reportperiod"), [], self.w.exact)

    def _inputs(self, base: DataFrame, lags: bool = True) -> DataFrame:
        """``base`` with every field of its filing, the lags of those, marketcap and ev."""
        x = _at_filing(base, fu.latest_period(self.filings).select(*fu.FILED, *bind.FULL_FIELDS))
        if lags:
            x = _at_filing(x, fu.lag_values(self.filings, lagged_fields()))
        return x.withColumn("marketcap", _cap("entry")).withColumn("ev", F.col("marketcap") + F.col("debt") - F.col("cashneq"))

    @property
    def inputs(self) -> DataFrame:
        return self._inputs(self.base)

    def _meta(self) -> dict[str, Column]:
        age = F.datediff("date", "datekey")
        out = {"fund_datekey": F.col("datekey"), "fund_reportperiod": F.col("reportperiod"), "fundamentals_age_days": age}
        out |= {f"has_filing_{n}d": F.coalesce(age <= n, F.lit(False)) for n in (183, 365)}
        return out | {"negative_equity": F.col("equity") <= 0, "negative_ebitda": F.col("ebitda") <= 0, "negative_ev": _cap("entry") + F.col("debt") - F.col("cashneq") <= 0}

    def meta(self) -> DataFrame:
        return self._inputs(self.base, False).select(*KEY, *[c.alias(n) for n, c in self._meta().items()])

    def _trend(self) -> DataFrame:
        return fu.trend_family(fu.filing_history(self.filings, list(SERIES)), fu.FILED, SERIES, positive=("ocf",))

    def trend(self) -> DataFrame:
        return fu.at_filing(self.base, self._trend(), KEY, "inner")

    def _dividends(self) -> DataFrame:
        r = fu.dividend_record(fu.filing_history(self.filings, ["div"], 10, fu.YEAR_DAYS), fu.FILED, "div")
        return r.select(*fu.FILED, F.col("years_paid").alias("div_years_paid_10y"), F.col("streak").alias("div_streak_10y"), F.col("cuts").alias("div_cuts_10y"), F.col("years_known").alias("div_history_years_10y"))

    def dividends(self) -> DataFrame:
        return fu.at_filing(self.base, self._dividends(), KEY, "inner")

    def _past_ratios(self) -> DataFrame:
        """Each bucket's ratios at the price of the day it was known, 45 days after its period at the latest; each filing meets its price once."""
        f = self.filings.select(*fu.FILED, "reportperiod", *dict.fromkeys([*RATIOS.values(), "sharesbas", "sharefactor"])).withColumn("anchor", F.least("datekey", F.date_add("reportperiod", 45)))
        p = asof_join(f, self.w.prices.select("entity", F.col("date").alias("p_date"), F.col("close").alias("p")), ["entity"], "anchor", "p_date", ["p"], "left", True, 14)
        p = p.select(*fu.FILED, "reportperiod", F.col("p_date").isNotNull().alias("priced"), *[c.alias(r) for r, c in _ratios("p").items()])
        hist = lagged_at_filing(p, ["priced", *RATIOS], range(20), fu.QUARTER_DAYS).where("priced")
        return fu.ratio_history(hist, fu.FILED, list(RATIOS))

    def relvalue(self) -> DataFrame:
        return _at_filing(self._inputs(self.base, False), self._past_ratios(), "inner").select(*KEY, *_relative())

    def classes(self) -> DataFrame:
        e = bind.entities(self.w.spark, self.w.dir)
        return e.select("entity", "sector", "industry", F.col("industry").alias("famaindustry"), F.col("category").alias("scalemarketcap"), F.col("code").cast("long").alias("siccode"))

    def all(self, only: list[str] | None = None) -> DataFrame:
        """``KEY`` and every feature that isn't made from ranks (or ``only`` these), in the registry's order, which is checked.

        Parts that ``only`` doesn't name aren't made.
        """
        names = [c for c in reg.columns(late=False) if only is None or c in only]
        of = lambda family: [c for c in reg.columns(family, late=False) if c in names]
        base = self.base
        if of("classification"):
            base = base.join(self.classes(), "entity", "left")
        series = [c for c in of("technical") if c != "log_marketcap"]
        if series:
            base = join_dealt(base, window_features(self.w, self.least).select(*KEY, *series), ["entity"], KEY[1:], "left")
        exprs = {n: e for f in FAMILIES.values() for n, e in f.items() if n in names}
        x = self._inputs(base, any(re.search(r"_t[123]\b", e) for e in exprs.values()))
        trend = [c for c in of("trend") if not c.startswith("div_")]
        parts = [(trend, self._trend), ([c for c in of("trend") if c not in trend], self._dividends), (of("relvalue"), self._past_ratios)]
        for cols, part in parts:
            if cols:
                x = _at_filing(x, part())
        made = {n: F.expr(e) for n, e in exprs.items()} | self._meta() | {"log_marketcap": safe_ln(F.when(F.col("entry") * F.col("sharesbas") > 0, F.col("entry") * F.col("sharesbas")))}
        if of("relvalue"):
            made |= {n: c for n, c in zip(reg.columns("relvalue"), _relative(), strict=True)}
        return exact_columns(x.select(*KEY, *[made[n].alias(n) if n in made else F.col(n) for n in names]), [*KEY, *names], "the panel")


def _at_filing(x: DataFrame, known: DataFrame, how: str = "left") -> DataFrame:
    return join_dealt(x, known, ["entity"], ["datekey"], how)


def _ratios(price: str) -> dict[str, Column]:
    return {r: F.col(v) / _cap(price) for r, v in RATIOS.items()}


def _relative() -> list[Column]:
    return [c for r, now in _ratios("entry").items() for c in fu.relative_to_history(r, now)]


def as_stored(df: DataFrame) -> DataFrame:
    """Features as they are stored: rounded, so that ranks don't depend on the order of sums."""
    return df.select(*[round6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame) -> DataFrame:
    """``as_stored``, written for steps that use it more than once."""
    return materialized(as_stored(df))


def ranks(panel: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Ranks within (quarter, kind).  Rows are dealt out by quarter: an entity's kinds, which share their filing's features, lie side by side and pack well."""
    specs = reg.rank_specs()
    return pn.cross_rank(panel, KEY, {c: specs[c] for c in only or specs}, ["quarter", "kind"], deal=["quarter"])


def sector_ranks(panel: DataFrame) -> DataFrame:
    return pn.cross_rank(panel, KEY, reg.sector_specs(), ["quarter", "kind", "sector"])


def composites(ranked: DataFrame) -> DataFrame:
    """conservative_score and magic_formula_score from ranks, and their own ranks."""
    x = as_stored(ranked)
    score = x.select(*KEY, F.round((1 - F.col("vol_36m_rank")) + F.col("mom_12_2_rank") + F.col("net_payout_yield_rank"), 9).alias("conservative_score"), F.round(F.col("ebit_to_ev_rank") + F.col("roc_greenblatt_rank"), 9).alias("magic_formula_score"))
    # ranked rows lie by (quarter, kind) still
    return pn.cross_rank(score, KEY, reg.rank_specs(late=True), ["quarter", "kind"], dealt=True, values=True).select(*KEY, *score.columns[len(KEY) :], *[f"{c}_rank" for c in reg.rank_specs(late=True)])


def mohanram(panel: DataFrame) -> DataFrame:
    """Six comparisons with the medians of (quarter, kind, industry) and one of the firm with itself, summed; null where any is."""
    by = ["quarter", "kind", "famaindustry"]
    j = panel.join(pn.group_medians(panel, by, list(MOHANRAM)), by, "left")
    total = (F.col("cfo_to_assets") > F.col("roa")).cast("int")
    for c, above in MOHANRAM.items():
        total = total + (F.col(c) > F.col(f"med_{c}") if above else F.col(c) < F.col(f"med_{c}")).cast("int")
    return j.select(*KEY, total.alias("mohanram_g7"))


def full_panel(features: DataFrame, ranked: DataFrame, labels: DataFrame, weights: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Features, ranks, labels and weights of every snapshot as one dataset, in this order of column groups, which is checked.

    ``labels`` has one row a snapshot and a column for each label and horizon,
    ``weights`` (entity, quarter, kind, h, weight) becomes weight_{h}y; what
    isn't observable yet is null.  Parts meet within their entity: those that
    lie by it (bucketed) are neither shuffled nor written again.
    """
    snap = ["entity", "quarter", "kind"]
    wide = weights.groupBy(*snap).agg(*[F.max(F.when(F.col("h") == h, F.col("weight"))).alias(f"weight_{h}y") for h in horizons])
    parts = [features, ranked.drop("date"), labels.drop("date"), wide]
    names = [*KEY, *[c for i, x in enumerate(parts) for c in x.columns if c not in (KEY if i == 0 else snap)]]
    out = features
    for x in reversed(parts[1:]):  # few columns first
        out = join_dealt(out, x, snap[:1], snap[1:], "left")
    return exact_columns(out.select(*names), names, "the full panel")


def rank_space(panel: DataFrame) -> DataFrame:
    """Median snapshots that have all of ``AXES``, each feature as its rank in the quarter."""
    full = panel.where("kind = 'median'").dropna(subset=AXES).select(*KEY, *AXES)
    r = pn.cross_rank(full, KEY, dict.fromkeys(AXES), ["quarter"], guard=1)
    return r.select("entity", "quarter", *[F.round(f"{c}_rank", 9).alias(c) for c in AXES])
