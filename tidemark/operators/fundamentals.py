"""Filings as known at a date: as-of base, lag matching, history buckets, feature families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import row_stddev, safe_div, safe_ln
from tidemark.operators.asof import asof_join, join_dealt, latest_by
from tidemark.operators.bands import band_stats, slope, spread
from tidemark.operators.bitemporal import lagged_at_filing

QUARTER_DAYS, YEAR_DAYS, YEAR = 91.3125, 365.25, 365.0  # lags count years of 365 days


def latest_period(filings: DataFrame) -> DataFrame:
    """One filing per (entity, datekey): the newest period."""
    return latest_by(filings, ["entity", "datekey"], F.col("reportperiod").desc())


def fund_base(snaps: DataFrame, filings: DataFrame, carry: list[str], allow_exact: bool = False) -> DataFrame:
    """Snapshots with the newest filing known before the date (at it, with ``allow_exact``)."""
    return asof_join(snaps, latest_period(filings), ["entity"], "date", "datekey", ["reportperiod", *carry], allow_exact=allow_exact)


def levels_with_flows(filings: DataFrame, level_dim: str, flow_dim: str, levels: list[str], flows: list[str]) -> DataFrame:
    """Filings of ``level_dim`` with the flows of the row of ``flow_dim`` that has the same key; without one the flows are null."""
    key = ["entity", "datekey", "reportperiod"]
    of = lambda dim, c: F.max(F.when(F.col("dimension") == dim, F.col(c))).alias(c)
    rows = filings.where(F.col("dimension").isin(level_dim, flow_dim)).groupBy(*key).agg(F.count_if(F.col("dimension") == level_dim).alias("__n"), *[of(level_dim, c) for c in levels], *[of(flow_dim, c) for c in flows])
    return rows.where("__n > 0").drop("__n")


FILED = ["entity", "datekey"]  # a day on which an entity filed


def at_filing(base: DataFrame, known: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """``key`` with what ``known`` (entity, datekey, ...) says about the day of each row's filing; ``base`` is ``fund_base`` of the same filings."""
    return base.select(*key, "datekey").join(known, FILED, how).select(*key, *[c for c in known.columns if c not in FILED])


def lag_presence(base: DataFrame, filings: DataFrame, key: list[str], lags: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``key``, has_t0 and has_t{k}: whether a filing of k years before the base period was known."""
    near = lagged_at_filing(filings, [], lags, YEAR).groupBy(*FILED).agg(*[F.bool_or(F.col("lag") == n).alias(f"has_t{n}") for n in lags])
    out = at_filing(base.withColumn("has_t0", F.col("datekey").isNotNull()), near, [*key, "has_t0"])
    return out.select(*key, "has_t0", *[F.coalesce(f"has_t{n}", F.lit(False)).alias(f"has_t{n}") for n in lags])


def lag_values(filings: DataFrame, values: list[str], lags: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """entity, datekey and the values k years before the newest period filed that day, within 30 days, newest version known; columns value_t1, ..."""
    best = lagged_at_filing(filings, values, lags, YEAR)
    return best.groupBy(*FILED).agg(*[F.max(F.when(F.col("lag") == n, F.col(v))).alias(f"{v}_t{n}") for v in values for n in lags])


def lag_match(base: DataFrame, filings: DataFrame, key: list[str], value: str | list[str], lags: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``lag_values`` of each row's filing; all null where there is none."""
    return at_filing(base, lag_values(filings, [value] if isinstance(value, str) else value, lags), key)


def filing_history(filings: DataFrame, values: list[str], n: int = 20, spacing: float = QUARTER_DAYS) -> DataFrame:
    """entity, datekey, off: the newest version known that day in each bucket 0..n-1 back from the newest period filed, with the next older bucket's values.

    ``prev_*`` is null unless the next older bucket is the very next one.
    """
    best = lagged_at_filing(filings, values, range(n), spacing).withColumnRenamed("lag", "off")
    w = Window.partitionBy(*FILED).orderBy("off")
    next_off = F.lead("off").over(w)
    return best.select(*FILED, "off", *values, *[F.when(next_off == F.col("off") + 1, F.lead(v).over(w)).alias(f"prev_{v}") for v in values])


def history_buckets(base: DataFrame, filings: DataFrame, key: list[str], values: list[str], n: int = 20, spacing: float = QUARTER_DAYS) -> DataFrame:
    """``filing_history`` of each row's filing; rows without one give nothing."""
    return at_filing(base, filing_history(filings, values, n, spacing), key, "inner")


def trend_stats(hist: DataFrame, key: list[str], value: str, windows: dict[int, int] | None = None) -> DataFrame:
    """Slope and fit of ln(value) over years, share of rises, for windows {quarters: least observations}."""
    windows = windows or {4: 3, 8: 5, 12: 7, 20: 11}
    x, y = -F.col("off") / F.lit(4.0), safe_ln(F.col(value))
    aggs = []
    for w, least in windows.items():
        inside = F.col("off") < w
        good = inside & (F.col(value) > 0)
        ok = (F.count_if(good) >= least) & (F.count_if(inside & (F.col(value) <= 0)) == 0)
        aggs += [F.when(ok, F.regr_slope(F.when(good, y), F.when(good, x))).alias(f"{value}_slope_{w}"), F.when(ok, F.regr_r2(F.when(good, y), F.when(good, x))).alias(f"{value}_r2_{w}")]
        pair = (F.col("off") <= w - 2) & F.col(f"prev_{value}").isNotNull() & F.col(value).isNotNull()
        n = F.count_if(pair)
        aggs.append(F.when(n >= least - 1, F.try_divide(F.count_if(pair & (F.col(value) > F.col(f"prev_{value}"))).cast("double"), n.cast("double"))).alias(f"{value}_up_{w}"))
        aggs.append(F.count_if(inside & F.col(value).isNotNull()).alias(f"{value}_n_{w}"))
    return hist.groupBy(*key).agg(*aggs)


TREND_WINDOWS = {4: 3, 8: 5, 12: 7, 20: 11}  # quarters: least observations


def trend_family(hist: DataFrame, key: list[str], series: dict[str, str], positive: tuple[str, ...] = (), windows: dict[int, int] | None = None) -> DataFrame:
    """Trend columns of several ``series`` (column: name) from one pass over the history.

    {name}_trend_{w}q, _consistency_{w}q and _up_frac_{w}q as in ``trend_stats``
    (a constant series fits with 1), {name}_positive_frac_{w}q for those in
    ``positive`` (null below the least observations), and fund_history_quarters.
    """
    windows = windows or TREND_WINDOWS
    slots = [(value, name, w, least) for value, name in series.items() for w, least in windows.items()]
    # a row for each series and window that holds it, so that few sums are kept at once, however many series and windows there are
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w"), F.col(value).cast("double").alias("v"), F.col(f"prev_{value}").cast("double").alias("prev")) for i, (value, _, w, _) in enumerate(slots)], F.struct(F.lit(-1).alias("i"), F.lit(0).alias("w"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("prev")))
    rows = hist.select(*key, "off", F.inline(each)).where("i < 0 or off < w")
    v, x, y = F.col("v"), -F.col("off") / F.lit(4.0), safe_ln(F.col("v"))
    pair = (F.col("off") <= F.col("w") - 2) & F.col("prev").isNotNull() & v.isNotNull()
    fit = lambda f: f(F.when(v > 0, y), F.when(v > 0, x))
    sums = {"slope": fit(F.regr_slope), "r2": fit(F.regr_r2), "good": F.count_if(v > 0), "bad": F.count_if(v <= 0), "known": F.count("v"), "rows": F.count("*"), "pairs": F.count_if(pair), "rises": F.count_if(pair & (v > F.col("prev")))}
    one = rows.groupBy(*key, "i").agg(*[c.alias(n) for n, c in sums.items()])
    # slot -1 counts the history's rows, whatever the windows
    wide = one.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct(*sums)))).alias("at"))
    out = []
    for i, (_, name, w, least) in enumerate(slots):
        at = F.col("at")[i]
        ok = (at["good"] >= least) & (at["bad"] == 0)
        share = lambda n, m: F.try_divide(n.cast("double"), m.cast("double"))
        out += [F.when(ok, at["slope"]).alias(f"{name}_trend_{w}q"), F.when(ok, at["r2"]).alias(f"{name}_consistency_{w}q")]
        out.append(F.when(at["pairs"] >= least - 1, share(at["rises"], at["pairs"])).alias(f"{name}_up_frac_{w}q"))
        if name in positive:
            out.append(F.when(at["known"] >= least, share(at["good"], at["known"])).alias(f"{name}_positive_frac_{w}q"))
    return wide.select(*key, *out, F.col("at")[-1]["rows"].alias("fund_history_quarters"))


def dividend_record(hist: DataFrame, key: list[str], value: str) -> DataFrame:
    """Years known, years paid, streak of paid years from the newest on, cuts below 0.8 of the year before."""
    w = Window.partitionBy(*key).orderBy("off")
    paid = F.col(value) > 0
    run = F.every(paid & (F.col("off") == F.col("rn") - 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = hist.withColumn("rn", F.row_number().over(w)).withColumn("on", run)
    return rows.groupBy(*key).agg(F.count(value).alias("years_known"), F.count_if(paid).alias("years_paid"), F.count_if("on").alias("streak"), F.count_if((F.col(f"prev_{value}") > 0) & (F.col(value) < 0.8 * F.col(f"prev_{value}"))).alias("cuts"))


def ratio_history(hist: DataFrame, key: list[str], ratios: list[str]) -> DataFrame:
    """``key`` and each ratio's past values as a sorted array ``past_{ratio}`` without nulls: one for each bucket at most."""
    return hist.groupBy(*key).agg(*[F.array_sort(F.collect_list(r)).alias(f"past_{r}") for r in ratios])


def relative_to_history(ratio: str, now: Column, least: int = 11) -> list[Column]:
    """{ratio}_vs_5y_median and {ratio}_5y_pctile from ``past_{ratio}``.

    The current ratio over the median of its own history (null unless the
    median is positive), and its midrank among past ratios; null below
    ``least`` observations.
    """
    past = F.col(f"past_{ratio}")
    n = F.size(past)
    med = (F.get(past, F.floor((n - 1) / 2).cast("int")) + F.get(past, F.floor(n / 2).cast("int"))) / F.lit(2.0)
    halves = F.aggregate(past, F.lit(0), lambda acc, h: acc + F.when(h < now, 2).when(h == now, 1).otherwise(0))
    return [F.when((n >= least) & (med > 0), now / F.when(med > 0, med)).alias(f"{ratio}_vs_5y_median"), F.when((n >= least) & now.isNotNull(), halves / F.lit(2.0) / n).alias(f"{ratio}_5y_pctile")]


def market_cap(base: DataFrame) -> DataFrame:
    """marketcap where positive."""
    cap = F.when(F.col("entry") * F.col("shares") > 0, F.col("entry") * F.col("shares"))
    return base.withColumn("marketcap", cap)


def market_inputs(base: DataFrame) -> DataFrame:
    """marketcap where positive, ev = marketcap + debt - cash."""
    return market_cap(base).withColumn("ev", F.col("marketcap") + F.col("debt") - F.col("cash"))


def meta(base: DataFrame, fresh: tuple[int, ...] = (135, 400), prefix: str = "fresh") -> DataFrame:
    """Age of the filing in days, freshness flags (false without a filing), sign flags (null without their fields)."""
    age = F.datediff("date", "datekey")
    out = base.withColumn("age_days", age).withColumn("period_age_days", F.datediff("date", "reportperiod")).withColumn("has_filing", F.col("datekey").isNotNull())
    for n in fresh:
        out = out.withColumn(f"{prefix}_{n}", F.coalesce(age <= n, F.lit(False)))
    return out.withColumn("loss_making", F.col("netinc") < 0).withColumn("negative_equity", F.col("assets") - F.col("liabilities") < 0)


def valuation(m: DataFrame) -> DataFrame:
    c = F.col
    return m.withColumn("earnings_yield", safe_div(c("netinc"), c("marketcap"))).withColumn("sales_yield", safe_div(c("revenue"), c("marketcap"))).withColumn("cash_yield", safe_div(c("ncfo"), c("marketcap"))).withColumn("ebit_to_ev", safe_div(c("ebit"), c("ev"))).withColumn("book_yield", safe_div(c("assets") - c("liabilities"), c("marketcap"))).withColumn("ev_to_marketcap", safe_div(c("ev"), c("marketcap"))).withColumn("dividend_yield", safe_div(c("dividends"), c("marketcap")))


def profitability(m: DataFrame) -> DataFrame:
    c = F.col
    return m.withColumn("gross_margin", safe_div(c("gp"), c("revenue"))).withColumn("net_margin", safe_div(c("netinc"), c("revenue"))).withColumn("roa", safe_div(c("netinc"), c("assets"))).withColumn("roe", safe_div(c("netinc"), c("assets") - c("liabilities"))).withColumn("gp_to_assets", safe_div(c("gp"), c("assets"))).withColumn("accruals", safe_div(c("netinc") - c("ncfo"), c("assets")))


def growth_family(m: DataFrame, value: str = "revenue") -> DataFrame:
    a, b, d = F.col(value), F.col(f"{value}_t1"), F.col(f"{value}_t3")
    return m.withColumn(f"{value}_growth_1y", safe_div(a - b, b)).withColumn(f"{value}_cagr_3y", F.when((d > 0) & (a >= 0), F.pow(F.when(d > 0, a / d), F.lit(1 / 3)) - 1))


def solvency(m: DataFrame) -> DataFrame:
    """Ratios and two published scores (Altman Z'' and Zmijewski), null where a part is."""
    c = F.col
    eq, ta, tl = c("assets") - c("liabilities"), c("assets"), c("liabilities")
    z = 6.56 * safe_div(c("assetsc") - c("liabilitiesc"), ta) + 3.26 * safe_div(c("retearn"), ta) + 6.72 * safe_div(c("ebit"), ta) + 1.05 * safe_div(eq, tl)
    zm = -4.336 - 4.513 * safe_div(c("netinc"), ta) + 5.679 * safe_div(tl, ta) + 0.004 * safe_div(c("assetsc"), c("liabilitiesc"))
    return m.withColumn("current_ratio", safe_div(c("assetsc"), c("liabilitiesc"))).withColumn("debt_to_assets", safe_div(c("debt"), ta)).withColumn("altman_z2", z).withColumn("zmijewski", zm)


def quality_family(m: DataFrame) -> DataFrame:
    """Sign flags summed as a score (null if any is), and the spread of revenue over four periods."""
    one = lambda x: x.cast("int")
    score = one(F.col("netinc") > 0) + one(F.col("ncfo") > 0) + one(F.col("ncfo") > F.col("netinc")) + one(F.col("revenue") > F.col("revenue_t1"))
    return m.withColumn("f_score", score).withColumn("revenue_sd", row_stddev(*[F.col(x) for x in ("revenue", "revenue_t1", "revenue_t2", "revenue_t3")]))


def returns_series(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """entity, date, ix, close, ret, log_ret, dollar, one_day (the print before was the trading day before)."""
    return price_ratios(prices, calendar).select("entity", "date", "ix", "close", (F.col("ratio") - 1).alias("ret"), F.ln("ratio").alias("log_ret"), "dollar", "one_day")


def price_ratios(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """What ``returns_series`` is made of: entity, date, ix, close, ratio (to the print before), dollar, one_day."""
    p = prices.join(F.broadcast(calendar), "date")
    w = Window.partitionBy("entity").orderBy("ix")
    return p.select("entity", "date", "ix", "close", (F.col("close") / F.lag("close").over(w)).alias("ratio"), (F.col("close") * F.col("volume")).alias("dollar"), F.coalesce(F.lag("ix").over(w) == F.col("ix") - 1, F.lit(False)).alias("one_day"))


def benchmark_returns(bench: DataFrame, calendar: DataFrame) -> DataFrame:
    """ix, bench_log_ret over the calendar where the day before has a price, too (some thousand rows, one partition)."""
    b = bench.join(F.broadcast(calendar), "date")
    w = Window.orderBy("ix")
    return b.select("ix", F.when(F.lag("ix").over(w) == F.col("ix") - 1, F.ln(F.col("bench") / F.lag("bench").over(w))).alias("bench_log_ret"))


# least observations of the twelve-month, three-year, five-year and 21-day features
TECHNICAL_LEAST = {"year": 200, "three": 600, "five": 1000, "month": 15}


REFERENCES = (21, 126, 252, 756)  # days back of reference prices


def window_features(snaps: DataFrame, series: DataFrame, bench: DataFrame, calendar: DataFrame, lookback: int = 1260, least: dict[str, int] | None = None, dealt: bool = False) -> DataFrame:
    """Momentum, reversal, highs, beta, volatility and liquidity over up to ``lookback`` trading days.

    ``series`` is as ``price_ratios``.  A reference price k days back is the last print in [k, k + 21] days back.
    Only returns from one trading day to the next count for max_ret_21d and
    beta; windows with fewer than ``least`` observations give null.  Everything
    is read from running states at the ends of the windows (``band_stats``);
    snapshots on one date of an entity share them.  Snapshots and series that
    lie by entity (bucketed) are not shuffled if ``dealt``.
    """
    need = {**TECHNICAL_LEAST, **(least or {})}
    month, quarter_, year, three, five = 21, 63, 252, 756, min(1260, lookback)
    s = snaps.join(F.broadcast(calendar), "date").select("entity", "kind", "quarter", "date", "entry", F.col("ix").alias("s_ix"))
    d = series.select("entity", "ix", "close", "ratio", "dollar", "one_day").join(F.broadcast(bench), "ix", "left")
    c, pair = F.col, F.col("one_day") & F.col("bench_log_ret").isNotNull()
    ret, log_ret = c("ratio") - 1, F.ln("ratio")
    both = pair & log_ret.isNotNull()
    one = F.lit(1).cast("long")
    measures = {
        "print": one, "close": c("close"), "quick": F.when(c("one_day"), one), "quick_ret": F.when(c("one_day"), ret), "log_ret": log_ret, "log_ret2": log_ret * log_ret,
        "pair": F.when(pair, one), "x": F.when(both, c("bench_log_ret")), "y": F.when(both, log_ret), "xy": F.when(both, c("bench_log_ret") * log_ret), "xx": F.when(both, c("bench_log_ret") * c("bench_log_ret")),
        "illiquid": F.try_divide(F.abs(ret), c("dollar")), "dollar": c("dollar"),
    }
    sums = {"print": [lookback + 1], "close": [five], "quick": [month], "log_ret": [year, three], "log_ret2": [year, three], "illiquid": [year], **{m: [year] for m in ("pair", "x", "y", "xy", "xx")}}
    b = band_stats(s, d, ["entity"], "s_ix", "ix", measures, sums, {"close": [year, five], "quick_ret": [month]}, {"close": [(k, k + 21) for k in REFERENCES]}, {"dollar": [quarter_]}, dealt)
    ref = lambda k: c(f"close_last_{k}_{k + 21}")
    sigma = lambda days, n: F.when(c(f"log_ret_n_{days}") >= n, spread(c(f"log_ret_n_{days}"), c(f"log_ret_sum_{days}"), c(f"log_ret2_sum_{days}")) * F.sqrt(F.lit(252.0)))
    enough = c(f"close_n_{five}") >= need["five"]
    j = (join_dealt(s, b, ["entity"], ["s_ix"]) if dealt else s.join(b, ["entity", "s_ix"])).where(c(f"print_n_{lookback + 1}") > 0)
    return j.select(
        "entity", "quarter", "kind", "date", "entry",
        (ref(21) / ref(252) - 1).alias("mom_12_2"), (ref(252) / ref(756) - 1).alias("mom_36_12"), (c("entry") / ref(126) - 1).alias("ret_6m"), (c("entry") / ref(21) - 1).alias("ret_1m"),
        F.when(c(f"quick_n_{month}") >= need["month"], c(f"quick_ret_max_{month}")).alias("max_ret_21d"), sigma(year, need["year"]).alias("vol_12m"), sigma(three, need["three"]).alias("vol_36m"),
        F.when(c(f"pair_n_{year}") >= need["year"], slope(*[c(f"{m}_{year}") for m in ("x_n", "x_sum", "y_sum", "xy_sum", "xx_sum")])).alias("beta_12m"),
        (c("entry") / c(f"close_max_{year}") - 1).alias("dist_52w_high"), F.when(enough, c("entry") / c(f"close_max_{five}") - 1).alias("dist_5y_high"), F.when(enough, c("entry") * c(f"close_n_{five}") / c(f"close_sum_{five}") - 1).alias("price_vs_5y_avg"),
        c(f"dollar_med_{quarter_}").alias("dollar_volume_3m"), (c(f"illiquid_sum_{year}") / c(f"illiquid_n_{year}")).alias("amihud_12m"), c(f"print_n_{lookback + 1}").alias("n_obs"),
    )


def family(df: DataFrame, name: str, key: list[str]) -> DataFrame:
    """One feature family as a projection: ``key`` and the family's columns in the registry's order."""
    from tidemark.functions.families import FAMILIES

    return df.selectExpr(*key, *[f"{e} AS {n}" for n, e in FAMILIES[name].items()])
