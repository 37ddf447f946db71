"""Lagged filings as known at a date, against loops over all filings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bitemporal import lagged_asof, lagged_at_filing, versions

D0 = dt.date(2000, 1, 1)
day = lambda n: D0 + dt.timedelta(n)


def tables(seed, n_entities=6):
    rnd = random.Random(seed)
    filings, base = [], []
    for e in range(n_entities):
        for q in range(16):
            period = q * 91 + rnd.randint(-12, 12)
            for _ in range(rnd.choice([0, 1, 1, 1, 2, 3])):  # late, restated, missing; several on one day
                filings.append((e, day(period + rnd.choice([30, 40, 45, 45, 200])), day(period), float(rnd.randint(1, 999))))
        for i in range(25):
            at = rnd.randint(0, 1700)
            known = [f for f in filings if f[0] == e and f[1] < day(at)]
            t0 = max(known, key=lambda f: (f[1], f[2]))[2] if known else None
            base.append((e, i, day(at), t0))
    filings += [(None, D0, D0, 1.0), (0, None, D0, 2.0), (0, D0, None, 3.0), (99, D0, D0, 4.0)]
    return filings, base


def brute(filings, base, lags, spacing, exact):
    out = []
    for e, i, at, t0 in base:
        for k in lags if t0 else ():
            near = []
            for f in filings:
                if f[0] != e or f[1] is None or f[2] is None or not (f[1] <= at if exact else f[1] < at) or f[2] > t0:
                    continue
                if abs((t0 - f[2]).days - k * spacing) <= 30:
                    near.append((f[1], f[2], f[3]))
            if near:
                out.append((e, i, at, k, *max(near)))
    return sorted(out)


@pytest.mark.parametrize(("seed", "lags", "spacing", "exact"), [(1, range(12), 91.3125, False), (2, (1, 2, 3), 365.0, True), (3, (0, 2), 365.25, False)])
def test_brute_force(spark, seed, lags, spacing, exact):
    filings, base = tables(seed)
    f = spark.createDataFrame(filings, "entity int, datekey date, reportperiod date, v double").withColumn("t0", F.lit("clash"))
    b = spark.createDataFrame(base, "entity int, id int, date date, reportperiod date").withColumn("v", F.lit("clash"))
    got = lagged_asof(b, f, ["entity", "id", "date"], ["v"], lags, spacing, allow_exact=exact)
    assert sorted(tuple(r) for r in got.collect()) == brute(filings, base, list(lags), spacing, exact)


def test_versions_are_intervals(spark):
    filings, _ = tables(4, 2)
    f = spark.createDataFrame(filings, "entity int, datekey date, reportperiod date, v double")
    t0s = f.select("entity", F.col("reportperiod").alias("t0"))
    got = versions(t0s, f, ["v"], (0, 1), 91.3125).collect()
    assert got
    groups = {}
    for r in got:
        assert r.known_to is None or r.known_to > r.known_from
        groups.setdefault((r.entity, r.t0, r.lag), []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: r.known_from)
        assert [r.known_to for r in rows] == [*[r.known_from for r in rows[1:]], None]  # no gap, no overlap
    with pytest.raises(ValueError, match="overlap"):
        versions(t0s, f, ["v"], (1,), 60.0)


def test_rows_grow_with_lags_asked_only(spark):
    """Many dates asked at don't multiply versions, and each (row, lag) gives one row at most."""
    filings = [(1, day(91 * q + 40), day(91 * q), float(q)) for q in range(40)]
    f = spark.createDataFrame(filings, "entity int, datekey date, reportperiod date, v double")
    b = spark.range(2000).select(F.lit(1).alias("entity"), "id", F.date_add(F.lit(D0), (F.col("id") + 1600).cast("int")).alias("date"))
    b = b.withColumn("reportperiod", F.date_add(F.lit(D0), (F.floor((F.datediff("date", F.lit(D0)) - 41) / 91) * 91).cast("int")))
    assert versions(b.select("entity", F.col("reportperiod").alias("t0")), f, ["v"], (0, 4, 8), 91.3125).count() <= 3 * 40
    got = lagged_asof(b, f, ["entity", "id", "date"], ["v"], (0, 4, 8), 91.3125)
    assert got.count() == 6000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # periods with filings, by day bucket


@pytest.mark.parametrize(("seed", "lags", "spacing"), [(5, range(12), 91.3125), (6, (1, 2, 3), 365.0)])
def test_what_a_filing_day_knows(spark, seed, lags, spacing):
    """Said once for each day on which an entity files, however many rows look back on it."""
    filings, _ = tables(seed)
    f = spark.createDataFrame(filings, "entity int, datekey date, reportperiod date, v double")
    days = {(e, d): max(p for e2, d2, p, _ in filings if (e2, d2) == (e, d) and p) for e, d, p, _ in filings if e is not None and d and p}
    base = [(e, 0, d, t0) for (e, d), t0 in days.items()]
    got = lagged_at_filing(f, ["v"], lags, spacing).collect()
    assert sorted((r[0], 0, *r[1:]) for r in got) == brute(filings, base, list(lags), spacing, True)
