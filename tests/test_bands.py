"""Statistics over bands of days against plain loops."""

import math
import random
from statistics import median, stdev

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bands import band_stats, slope, spread


def rows_of(seed):
    rnd = random.Random(seed)
    series, asks = [], []
    for k in ["a", "b", None, "only prints"]:
        days = sorted(rnd.sample(range(-60, 200), 90))
        series += [(k, d, rnd.choice([None, rnd.randint(-50, 50)]), rnd.choice([rnd.uniform(-1, 1), float("nan")])) for d in days]
        if k != "only prints":
            asks += [(k, rnd.randint(-80, 230)) for _ in range(60)]
    asks += [("only asks", 5), ("a", None), ("a", 7), ("a", 7)]
    series += [("a", None, 5, 0.5)]
    return series, asks


def brute(series, asks):
    out = {}
    for k, at in {a for a in asks if a[1] is not None}:
        band = lambda n, c: [r[c] for r in series if r[0] == k and r[1] is not None and at - n < r[1] <= at and r[c] is not None and r[c] == r[c]]  # noqa: B023, E731
        row = {}
        for n in (1, 7, 30, 200):
            v = band(n, 2)
            row |= {f"v_n_{n}": len(v), f"v_sum_{n}": sum(v) if v else None, f"v_max_{n}": max(v, default=None)}
        row["w_max_30"] = max(band(30, 3), default=None)
        row["v_med_9"] = float(median(band(9, 2))) if k is not None and band(9, 2) else None
        for lo, hi in ((0, 3), (10, 31)):
            near = [(r[1], r[2]) for r in series if r[0] == k and r[1] is not None and lo <= at - r[1] <= hi]
            row[f"v_last_{lo}_{hi}"] = max(near)[1] if near else None
        out[k, at] = row
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    series, asks = rows_of(seed)
    s = spark.createDataFrame(series, "k string, day int, v long, w double").withColumn("at", F.lit("clash"))
    a = spark.createDataFrame(asks, "k string, at int").withColumn("v", F.lit(9))
    got = band_stats(a, s, ["k"], "at", "day", {"v": F.col("v"), "w": F.col("w")}, {"v": [1, 7, 30, 200]}, {"v": [1, 7, 30, 200], "w": [30]}, {"v": [(0, 3), (10, 31)]}, {"v": [9]})
    have = {(r.k, r.at): {c: r[c] for c in got.columns if c not in ("k", "at")} for r in got.collect()}
    assert have == brute(series, asks)


def test_moments(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.gauss(0, 0.02), rnd.gauss(0, 0.01)) for i in range(400)]
    s = spark.createDataFrame(pts, "ix int, y double, x double").withColumn("k", F.lit(1))
    m = {"x": F.col("x"), "y": F.col("y"), "xy": F.col("x") * F.col("y"), "xx": F.col("x") ** 2, "yy": F.col("y") ** 2}
    b = band_stats(s.where("ix in (30, 399)"), s, ["k"], "ix", "ix", m, dict.fromkeys(m, [50]))
    c = F.col
    r = b.select("ix", spread(c("y_n_50"), c("y_sum_50"), c("yy_sum_50")).alias("sd"), slope(c("x_n_50"), c("x_sum_50"), c("y_sum_50"), c("xy_sum_50"), c("xx_sum_50")).alias("beta")).collect()
    assert len(r) == 2
    for row in r:
        band = [p for p in pts if row.ix - 50 < p[0] <= row.ix]
        mx, my = sum(p[2] for p in band) / len(band), sum(p[1] for p in band) / len(band)
        beta = sum((p[2] - mx) * (p[1] - my) for p in band) / sum((p[2] - mx) ** 2 for p in band)
        assert math.isclose(row.sd, stdev(p[1] for p in band), rel_tol=1e-9) and math.isclose(row.beta, beta, rel_tol=1e-9)
    flat = s.withColumn("x", F.lit(0.1)).withColumn("y", F.lit(3.0))
    m = {k: {"x": F.col("x"), "y": F.col("y"), "xy": F.col("x") * F.col("y"), "xx": F.col("x") ** 2, "yy": F.col("y") ** 2}[k] for k in m}
    z = band_stats(flat.where("ix = 399"), flat, ["k"], "ix", "ix", m, dict.fromkeys(m, [50])).select(spread(c("y_n_50"), c("y_sum_50"), c("yy_sum_50")).alias("sd"), slope(c("x_n_50"), c("x_sum_50"), c("y_sum_50"), c("xy_sum_50"), c("xx_sum_50")).alias("beta")).first()
    assert z.sd < 1e-6 and z.beta is None  # nothing varies


def test_no_row_of_the_series_meets_an_ask(spark):
    s = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("ix"), F.col("id").alias("v"))
    df = band_stats(s.limit(10), s, ["k"], "ix", "ix", {"v": F.col("v")}, {"v": [500]}, {"v": [500]}, {"v": [(1, 5)]})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    empty = band_stats(s.limit(0), s, ["k"], "ix", "ix", {"v": F.col("v")}, {"v": [500]}, medians={"v": [3]})
    assert empty.collect() == []
