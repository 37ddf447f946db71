"""Reports on a panel: coverage, null rates, staleness, update lags, variation, flips, neighbours, purge cost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import add_years, md5_number, month_gap, safe_corr
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources.io import materialized


def null_rates(df: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """field, by..., n, null_rate from one pass over the panel."""
    g = df.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(F.col(f).isNull().cast("double")).alias(f) for f in fields])
    return g.unpivot([*by, "n"], fields, "field", "null_rate")


def top_null_rates(rates: DataFrame, k: int = 15) -> DataFrame:
    g = rates.groupBy("field").agg((F.sum(F.col("null_rate") * F.col("n")) / F.sum("n")).alias("rate"))
    return g.orderBy(F.desc(F.round("rate", 9)), "field").limit(k)


def staleness_buckets(df: DataFrame, age: str, flag: str, edges: tuple[int, ...] = (45, 90, 135, 180, 400)) -> DataFrame:
    """bucket, n, share of all rows, share of ``flag``; a missing age is a bucket of its own."""
    b = F.when(F.col(age).isNull(), "none")
    lo = 0
    for e in edges:
        b = b.when(F.col(age) <= e, f"{lo:03d}-{e:03d}")
        lo = e + 1
    g = df.withColumn("bucket", b.otherwise(f"{lo:03d}-")).groupBy("bucket").agg(F.count("*").alias("n"), F.avg(F.col(flag).cast("double")).alias("flag_share"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def staleness_by_year(df: DataFrame, age: str, date: str, limit: int = 135) -> DataFrame:
    g = df.groupBy(F.year(date).alias("year"), F.coalesce(F.col(age) <= limit, F.lit(False)).alias("fresh")).agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("year")))


def update_lag(df: DataFrame, lag: Column, year: Column, limit: int = 35) -> DataFrame:
    """year, n, median and 95th percentile of ``lag``, share above ``limit``; years without a lag stay, with n = 0."""
    rows = df.select(year.alias("year"), lag.alias("lag"))
    q = exact_quantiles(rows, ["year"], "lag", {"median_lag": 0.5, "p95_lag": 0.95}).drop("n")
    g = rows.groupBy("year").agg(F.count("lag").alias("n"), F.avg((F.col("lag") > limit).cast("double")).alias("share_late"))
    return g.join(q.withColumnRenamed("year", "y"), F.col("year").eqNullSafe(F.col("y")), "left").select("year", "n", "median_lag", "p95_lag", "share_late")


def md5_sample(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """``n`` rows in the order of an md5: the same sample in any engine."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))
    return df.withColumn("__h", h).orderBy("__h", *cols).limit(n).drop("__h")


def replication_error(df: DataFrame, reported: str, computed: str) -> DataFrame:
    """Scale between two sources (median ratio) and the error left after it; no row without a pair above 0."""
    ok = df.where((F.col(reported) > 0) & (F.col(computed) > 0)).select(F.col(reported).alias("r"), F.col(computed).alias("c"))
    scale = exact_quantiles(ok.select((F.col("r") / F.col("c")).alias("ratio")), [], "ratio", {"scale": 0.5}).select("scale")
    err = materialized(ok.crossJoin(F.broadcast(scale)).select("scale", F.abs(F.col("r") / (F.col("c") * F.col("scale")) - 1).alias("err")))  # one row of scale
    q = exact_quantiles(err, [], "err", {"median_err": 0.5, "p90_err": 0.9})
    g = err.groupBy("scale").agg(F.avg((F.col("err") <= 0.01).cast("double")).alias("within_1pct"), F.avg((F.col("err") <= 0.05).cast("double")).alias("within_5pct"))
    return g.crossJoin(F.broadcast(q)).select("scale", "n", "median_err", "p90_err", "within_1pct", "within_5pct")


def coverage(df: DataFrame, by: str, age: str, rates: dict[str, Column]) -> DataFrame:
    """by, n, median of ``age`` and the share of rows of each of ``rates`` (a null is no)."""
    g = df.groupBy(by).agg(F.count("*").alias("n"), *[F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(k) for k, c in rates.items()])
    q = exact_quantiles(df.select(F.col(by).alias("__by"), F.col(age).alias("__age")), ["__by"], "__age", {"median_age": 0.5}).drop("n")
    return g.join(q, F.col(by).eqNullSafe(F.col("__by")), "left").select(by, "n", "median_age", *rates)


def source_discrimination(df: DataFrame, reported: str, first: str, latest: str) -> DataFrame:
    """Of rows where two versions differ by over 1 %: how often the first one, or the latest, is nearer to the report."""
    ok = df.where((F.col(reported) > 0) & (F.col(first) > 0) & (F.col(latest) > 0)).where(F.abs(F.col(first) / F.col(latest) - 1) > 0.01)
    e1, e2 = F.abs(F.ln(F.col(reported) / F.col(first))), F.abs(F.ln(F.col(reported) / F.col(latest)))
    return ok.agg(F.count("*").alias("n"), F.count_if(e1 < e2).alias("first_nearer"), F.count_if(e1 > e2).alias("latest_nearer"))


def long_form(df: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """One row per non-null value."""
    return df.select(*key, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(key, cols, "feature", "value").where("value is not null")


def intra_group_variation(long: DataFrame, by: list[str]) -> DataFrame:
    """Per feature: groups with two or more values, share in which they differ, median range relative to the middle value."""
    g = long.groupBy(*by, "feature").agg(F.count("*").alias("n"), F.max("value").alias("hi"), F.min("value").alias("lo"), F.expr("percentile_disc(0.5) within group (order by value)").alias("mid")).where("n >= 2")
    rel = F.try_divide(F.col("hi") - F.col("lo"), F.nullif(F.abs("mid"), F.lit(0.0)))
    return g.groupBy("feature").agg(F.count("*").alias("n_groups"), F.avg((F.col("hi") > F.col("lo")).cast("double")).alias("share_differ"), F.median(rel).alias("median_range"))


def straddle(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Groups that see more than one filing, 'none' being a state of its own."""
    g = df.groupBy(*by).agg(F.count_distinct(F.coalesce(F.col(col).cast("string"), F.lit("none"))).alias("k"))
    return g.agg(F.count("*").alias("n_groups"), F.count_if(F.col("k") > 1).alias("n_straddle")).withColumn("share", F.try_divide(F.col("n_straddle").cast("double"), F.col("n_groups").cast("double")))


def flip_rates(df: DataFrame, by: list[str], kind: str, a: str, b: str, flags: list[str]) -> DataFrame:
    """Per flag: groups in which both kinds have it, and how often it differs; flags without groups stay, with 0."""
    side = lambda f, k: F.max(F.when(F.col(kind) == k, F.col(f).cast("int")))
    g = df.groupBy(*by).agg(*[side(f, k).alias(f"{f}__{n}") for f in flags for n, k in (("a", a), ("b", b))])
    both = lambda f: F.col(f"{f}__a").isNotNull() & F.col(f"{f}__b").isNotNull()
    one = g.agg(*[F.struct(F.count_if(both(f)).alias("n"), F.count_if(both(f) & (F.col(f"{f}__a") != F.col(f"{f}__b"))).alias("flips")).alias(f) for f in flags])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"{f}.n").alias("n_groups"), F.col(f"{f}.flips").alias("n_flips")) for f in flags])))
    return rows.withColumn("rate", F.try_divide(F.col("n_flips").cast("double"), F.col("n_groups").cast("double")))


def variance_decomposition(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Share of each column's variance that lies within groups."""
    g = long_form(df, by, cols).groupBy(*by, "feature").agg(F.count("*").alias("n"), F.var_pop("value").alias("v"), F.avg("value").alias("m"))
    grand = F.sum(F.col("m") * F.col("n")).over(Window.partitionBy("feature")) / F.sum("n").over(Window.partitionBy("feature"))
    g = g.withColumn("between", F.col("n") * (F.col("m") - grand) * (F.col("m") - grand)).withColumn("within", F.col("n") * F.col("v"))
    return g.groupBy("feature").agg(F.sum("n").alias("n"), F.try_divide(F.sum("within"), F.sum("within") + F.sum("between")).alias("within_share"))


def serial_correlation(df: DataFrame, entity: str, quarter: str, value: str, lags: list[int]) -> DataFrame:
    """Correlation of a label with itself ``lag`` quarters later."""
    a = df.where(F.col(value).isNotNull()).select(F.col(entity).alias("e"), F.col(quarter).alias("q"), F.col(value).alias("x")).withColumn("lag", F.explode(F.array(*map(F.lit, lags))))
    b = df.where(F.col(value).isNotNull()).select(F.col(entity).alias("e"), F.col(quarter).alias("q2"), F.col(value).alias("y"))
    j = a.withColumn("q2", F.add_months("q", 3 * F.col("lag"))).join(b, ["e", "q2"])
    return j.groupBy("lag").agg(F.count("*").alias("n"), safe_corr(F.col("x"), F.col("y")).alias("corr"))


def nearest_neighbours(space: DataFrame, sample: DataFrame, axes: list[str], entity: str, quarter: str) -> DataFrame:
    """The exact nearest row for each sample row, never of its own (entity, quarter), with the relation of the two.

    The sample has a fixed size and is broadcast; each task keeps the best
    partner it has seen, so no pair is shuffled.
    """
    s = sample.select(F.col(entity).alias("s_e"), F.col(quarter).alias("s_q"), *[F.col(c).alias(f"__s{i}") for i, c in enumerate(axes)])
    t = space.select(F.col(entity).alias("t_e"), F.col(quarter).alias("t_q"), *[F.col(c).alias(f"__t{i}") for i, c in enumerate(axes)])
    # plain columns, so that the distance is compiled with the join
    d = reduce(lambda total, i: total + (F.col(f"__s{i}") - F.col(f"__t{i}")) * (F.col(f"__s{i}") - F.col(f"__t{i}")), range(len(axes)), F.lit(0.0))
    j = t.join(F.broadcast(s), (F.col("s_e") != F.col("t_e")) | (F.col("s_q") != F.col("t_q"))).select("s_e", "s_q", "t_e", "t_q", F.round(d, 9).alias("d2"))
    best = j.groupBy("s_e", "s_q").agg(F.min(F.struct("d2", "t_e", "t_q")).alias("m"))
    gap = F.abs(month_gap(F.col("m.t_q"), F.col("s_q")))
    relation = F.when((F.col("m.t_e") == F.col("s_e")) & (gap <= 12), "same entity, near").when(F.col("m.t_e") == F.col("s_e"), "same entity, far").when(F.col("m.t_q") == F.col("s_q"), "same quarter").otherwise("other")
    return best.select("s_e", "s_q", F.col("m.t_e").alias("t_e"), F.col("m.t_q").alias("t_q"), F.col("m.d2").alias("d2"), relation.alias("relation"))


def random_partners(df: DataFrame, key: list[str]) -> DataFrame:
    """Each row of a sample with a partner drawn by hash: rn and the partner's rn."""
    n = F.count("*").over(Window.partitionBy())
    rn = F.row_number().over(Window.orderBy(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])), *key))
    rows = df.select(*key, rn.alias("rn"), n.alias("n")).withColumn("partner", 1 + md5_number(F.lit("p"), *[F.col(k) for k in key]) % F.col("n"))
    other = rows.select(F.col("rn").alias("partner"), *[F.col(k).alias(f"p_{k}") for k in key])
    return rows.join(other, "partner").select(*key, *[f"p_{k}" for k in key])


def purge_cost(snaps: DataFrame, boundaries: DataFrame, horizons: tuple[int, ...], embargo_days: int = 30) -> DataFrame:
    """Rows kept, purged and tested at each boundary and horizon; snapshots are counted by date first."""
    per = snaps.groupBy("date").agg(F.count("*").alias("n"))
    grid = boundaries.withColumn("h", F.explode(F.array(*map(F.lit, horizons))))
    j = per.join(F.broadcast(grid))
    end = F.date_add(add_years(F.col("date"), F.col("h")), embargo_days)
    before, kept = F.col("date") < F.col("boundary"), F.col("date") < F.col("boundary")
    kept = before & (end < F.col("boundary"))
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return j.groupBy("boundary", "h").agg(n(before).alias("n_before"), n(kept).alias("n_train"), n(before & ~kept).alias("n_purged"), n(~before).alias("n_after"))


def tier_flags(df: DataFrame, least_12m: int = 200, least_36m: int = 600) -> DataFrame:
    """t0 to t3 (a filing, and all lags up to k), p12 and p36 (enough prints) from has_t0..3, n_12m, n_36m."""
    t = F.col("has_t0")
    flags = {"t0": t}
    for k in (1, 2, 3):
        t = t & F.col(f"has_t{k}")
        flags[f"t{k}"] = t
    return df.withColumns(flags | {"p12": F.coalesce(F.col("n_12m") >= least_12m, F.lit(False)), "p36": F.coalesce(F.col("n_36m") >= least_36m, F.lit(False))})


def newest_by_dimension(filings: DataFrame, dimensions: tuple[str, ...], entity: str = "entity") -> DataFrame:
    """One filing per (dimension, entity, datekey): the newest period."""
    w = Window.partitionBy("dimension", entity, "datekey").orderBy(F.col("reportperiod").desc())
    return filings.where(F.col("dimension").isin(*dimensions)).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def two_sided(daily: DataFrame, filings: DataFrame, first: str, latest: str, value: str) -> DataFrame:
    """Daily rows with ``value`` as first reported (rows without one go) and as restated later, each as known the day before."""
    from tidemark.operators.asof import asof_join

    side = lambda dim: filings.where(F.col("dimension") == dim).select("entity", F.col("datekey").alias(f"datekey_{dim.lower()}"), F.col(value).alias(f"{value}_{dim.lower()}"))
    out = asof_join(daily, side(first), ["entity"], "date", f"datekey_{first.lower()}", [f"{value}_{first.lower()}"], how="inner", allow_exact=False)
    return asof_join(out, side(latest), ["entity"], "date", f"datekey_{latest.lower()}", [f"{value}_{latest.lower()}"], allow_exact=False)


def weighted_share(df: DataFrame, share: str, weight: str) -> DataFrame:
    """One row: n and the average of ``share`` by ``weight``."""
    return df.agg(F.sum(weight).alias("n"), F.try_divide(F.sum(F.col(share) * F.col(weight)), F.sum(weight)).alias(share))


def twin_report(nearest: DataFrame, random: DataFrame, labels: DataFrame, value: str) -> DataFrame:
    """relation, n, share, n_labelled, corr, mean_abs_diff of a label between sample rows and their partners.

    ``nearest`` has s_e, s_q, t_e, t_q, relation; ``random`` s_e, s_q, t_e, t_q;
    ``labels`` entity, quarter and ``value``.  Shares are among all nearest, or all random, partners.
    """
    cols = ["s_e", "s_q", "t_e", "t_q"]
    pairs = nearest.select(*cols, "relation").unionByName(random.select(*cols).withColumn("relation", F.lit("random")))
    a = labels.select(F.col("entity").alias("s_e"), F.col("quarter").alias("s_q"), F.col(value).alias("x"))
    b = labels.select(F.col("entity").alias("t_e"), F.col("quarter").alias("t_q"), F.col(value).alias("y"))
    j = pairs.join(a, ["s_e", "s_q"], "left").join(b, ["t_e", "t_q"], "left")
    g = j.groupBy("relation").agg(F.count("*").alias("n"), F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("n_labelled"), safe_corr(F.col("x"), F.col("y")).alias("corr"), F.avg(F.abs(F.col("x") - F.col("y"))).alias("mean_abs_diff"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.col("relation") == "random")))
