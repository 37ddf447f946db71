"""Quantiles by place, runs and paths, audit detail and bucketed tables against loops."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.panel import audit_detail
from tidemark.operators.paths import path_days, path_stats, paths, price_runs
from tidemark.operators.quantiles import exact_quantiles, places
from tidemark.sources.io import bucketed

PROBS = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q95": 0.95, "q100": 1.0}


@pytest.mark.parametrize("discrete", [False, True])
def test_quantiles(spark, discrete):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, float(rnd.randint(0, 9)), rnd.gauss(0, 1e6)])) for _ in range(900)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.lit("clash"))
    got = {r.g: r for r in exact_quantiles(df.select("g", "v"), ["g"], "v", PROBS, discrete).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, r in got.items():
        x = np.array([v for k, v in rows if k == g and v is not None])
        assert r.n == len(x)
        want = np.quantile(x, list(PROBS.values()), method="inverted_cdf" if discrete else "linear")
        assert np.allclose([r[c] for c in PROBS], want, rtol=1e-12)
    assert exact_quantiles(df.limit(0).select("g", "v"), ["g"], "v", PROBS).collect() == []
    assert exact_quantiles(df.limit(0).select("v"), [], "v", PROBS).collect() == []
    with pytest.raises(ValueError, match="between 0 and 1"):
        exact_quantiles(df, ["g"], "v", {"x": 1.5})


def test_one_large_group(spark):
    """Two million distinct values in one group: they lie in several ranges, and the plan has no aggregate that collects values."""
    df = spark.range(2_000_000).select(F.lit(1).alias("g"), ((F.col("id") * 1_000_003) % 2_000_000).alias("v"))
    p = places(df, ["g"], "v")
    assert "percentile" not in p._jdf.queryExecution().optimizedPlan().toString().lower()
    r = exact_quantiles(df, ["g"], "v", {"median": 0.5, "late": 0.999}).first()
    assert (r.n, r.median, round(r.late, 3)) == (2_000_000, 999_999.5, round(0.999 * 1_999_999, 3))


def test_paths(spark):
    rnd = random.Random(5)
    days = [dt.date(2001, 1, 1) + dt.timedelta(i) for i in range(150)]
    cal = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "date date, ix int")
    prints = {e: sorted(rnd.sample(range(10 * e, 100 + 10 * e), 20 if e else 2)) for e in range(4)}
    rows = [(e, days[i], float(rnd.randint(1, 99))) for e, ix in prints.items() for i in ix] + [(2, days[0], None)]
    runs = price_runs(spark.createDataFrame(rows, "entity int, date date, close double"), cal)
    asks = [(e, k, a, min(150, a + n)) for e in [*prints, 9] for k in range(15) for a, n in [(rnd.randint(1, 150), rnd.choice([0, 20, 120]))]]
    key = ["entity", "k"]
    p = paths(spark.createDataFrame(asks, "entity int, k int, start_ix int, end_ix int"), runs, key)
    price = {(e, d): c for e, d, c in rows if c is not None}
    want, stats = set(), {}
    for e, k, a, z in asks:
        path = []
        for ix in range(a, z + 1):
            held = [i for i in prints.get(e, []) if i + 1 <= ix]
            if held:
                path.append((price[e, days[held[-1]]], ix > prints[e][-1] + 1))
                want.add((e, k, ix, days[ix - 1], *path[-1]))
        if path:
            v = [c for c, _ in path]
            stats[e, k] = (len(v), sum(v) / len(v), min(v), max(v), v[-1], sum(x for _, x in path))
    got = [(r.entity, r.k, r.ix, r.day, r.price, r.is_extension) for r in path_days(p, cal).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    have = {(r.entity, r.k): tuple(r)[2:] for r in path_stats(p, key).collect()}
    assert have.keys() == stats.keys() and all(np.allclose(have[x], stats[x]) for x in stats)


def test_audit_detail(spark):
    rows = [("q1", "m", 0.5, 7.0)] * 3 + [("q1", "m", 0.1, 1.0), ("q1", "m", 0.2, 2.0), ("q2", "m", 0.5001, 9.0), ("q2", "m", 0.5001, 8.0), ("q2", "m", 0.1, 1.0), ("q2", "m", None, 3.0)]
    rows += [("q1", "n", 0.3, 1.0), ("q2", "n", 0.3, 1.0), ("q2", "n", 0.3, 1.0)]  # 0.3 stands in both: not keyed
    df = spark.createDataFrame(rows, "q string, kind string, x_rank double, x double")
    got = audit_detail(df, {"x_rank": "x"}, "q", "kind", most=0.02, k=2).collect()
    assert [(r.column, r.kind, r.place, round(r.share, 3), r.key_partition, r.key_rank, r.key_raw) for r in sorted(got, key=lambda r: r.place)] == [("x_rank", "m", 1, 0.667, "q2", 0.5001, 8.0), ("x_rank", "m", 2, 0.6, "q1", 0.5, 7.0)]
    assert audit_detail(df, {"x_rank": "x"}, "q", "kind", most=0.7).collect() == []


def test_bucketed_tables_join_in_place(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias(c)) for c in ("id", "x"))
        j = bucketed(a, ["k", "id"]).join(bucketed(b.withColumnRenamed("x", "id").withColumn("y", F.col("id")), ["k", "id"]), ["k", "id"])
        assert j.count() == 100 and "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
