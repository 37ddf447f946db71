import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.exprs import row_stddev, safe_corr, safe_div, safe_ln
from tidemark.functions.registry import columns, faults, rank_specs
from tidemark.operators import panel as pn
from tidemark.operators import snapshots as sn
from tidemark.operators.asof import asof_join, band_join, validity_join
from tidemark.operators.fundamentals import dividend_record

D = dt.date


def day(n):
    return D(2015, 1, 1) + dt.timedelta(days=n)


def test_expressions(spark):
    r = spark.sql("select 1.0D a, 0.0D z, 3.0D b").select(safe_div(F.col("a"), F.col("z")).alias("d"), safe_ln(F.col("z")).alias("l"), row_stddev(F.col("b"), F.col("b"), F.col("b")).alias("s")).first()
    assert r.d is None and r.l is None and r.s == 0.0
    assert spark.range(5).agg(safe_corr(F.col("id").cast("double"), F.lit(1.0)).alias("c")).first().c is None


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_against_brute_force(spark, exact, tolerance):
    random.seed(1)
    left = [(i, random.choice([1, 2, None]), day(random.randint(0, 40))) for i in range(60)] + [(99, 1, None)]
    right = list({(k, n): (k, day(n), float(n)) for k in (1, 2, None) for n in random.sample(range(40), 8)}.values())
    lf = spark.createDataFrame(left, "i int, k int, t date")
    rf = spark.createDataFrame(right, "k int, u date, v double")
    got = {r.i: r.v for r in asof_join(lf, rf, ["k"], "t", "u", ["v"], "left", exact, tolerance).collect()}
    for i, k, t in left:
        ok = [] if t is None else [(u, v) for q, u, v in right if q == k and (u <= t if exact else u < t) and (tolerance is None or (t - u).days <= tolerance)]
        assert got[i] == (max(ok)[1] if ok else None)
    assert asof_join(lf.limit(0), rf, ["k"], "t", "u", ["v"]).count() == 0


def test_band_join_against_brute_force(spark):
    random.seed(2)
    a = [(k, random.randint(0, 60)) for k in (1, 2) for _ in range(10)]
    b = [(k, n) for k in (1, 2) for n in random.sample(range(60), 30)]
    got = sorted((r.k, r.x, r.ix) for r in band_join(spark.createDataFrame(a, "k int, x int").distinct(), spark.createDataFrame(b, "k int, ix int"), ["k"], "x", "ix", 7, []).collect())
    assert got == sorted((k, x, n) for k, x in set(a) for q, n in b if q == k and x - 7 <= n <= x)


def test_validity_join_nearest_and_grace(spark):
    facts = spark.createDataFrame([("A", day(5)), ("A", day(50)), ("B", day(999)), ("A", day(400))], "t string, d date")
    m = spark.createDataFrame([("A", None, day(10), 1, True), ("A", day(40), day(60), 2, True), ("B", day(0), day(1), 3, False)], "t string, f date, l date, e int, reused boolean")
    got = {(r.t, r.d): r.e for r in validity_join(facts, m, "t", "d", "f", "l", "e", 20, 20, True, "reused").collect()}
    assert got == {("A", day(5)): 1, ("A", day(50)): 2, ("B", day(999)): 3}


def test_zigzag_snapshots(spark):
    """Golden values: seven prints with median 30, low 10, high 50."""
    path = zip([D(2015, 1, d) for d in (1, 2, 5, 6, 7, 8, 9)], [20.0, 40.0, 30.0, 10.0, 30.0, 50.0, 30.0], strict=True)
    p = spark.createDataFrame([(1, d, c, 1.0) for d, c in path], "entity int, date date, close double, volume double")
    got = {r.kind: (r.date, r.entry, r.n_days) for r in sn.touch_snapshots(p).collect()}
    assert got == {"median": (D(2015, 1, 5), 30.0, 7), "low": (D(2015, 1, 6), 10.0, 7), "high": (D(2015, 1, 8), 50.0, 7)}


def test_drawdown_against_daily_scan(spark):
    random.seed(5)
    rows = [(e, day(n), random.uniform(10, 100)) for e in (1, 2) for n in range(400) if random.random() < 0.3]
    p = spark.createDataFrame(rows, "entity int, date date, close double")
    picks = random.sample(rows, 40)
    spans = [(e, "k", d, c, i % 3, d + dt.timedelta(days=random.randint(0, 300))) for i, (e, d, c) in enumerate(picks)]
    got = {(r.entity, r.date, r.h): (r.max_drawdown, r.fall_from_entry) for r in sn.max_drawdown(p, spark.createDataFrame(spans, "entity int, kind string, date date, entry double, h int, end_date date")).collect()}
    for e, _, d, c, h, end in spans:
        path = [x for q, t, x in sorted(rows, key=lambda r: r[1]) if q == e and d <= t <= end]
        peak, worst = 0.0, 0.0
        for x in path:
            peak = max(peak, x)
            worst = max(worst, 1 - x / peak)
        assert got[e, d, h] == pytest.approx((worst, max(0.0, 1 - min(path) / c)), abs=1e-12)


def test_weights_against_days(spark):
    rows = [(1, i, day(a), day(b)) for i, (a, b) in enumerate([(0, 9), (5, 5), (5, 20), (30, 40)])] + [(2, 9, day(0), day(3)), (2, 10, None, day(3))]
    got = {r.i: r.weight for r in pn.uniqueness_weights(spark.createDataFrame(rows, "e int, i int, s date, t date"), "e", "s", "t", ["i"]).collect()}
    for e, i, s, t in rows:
        if s is None:
            assert got[i] is None
            continue
        days = [s + dt.timedelta(days=k) for k in range((t - s).days + 1)]
        open_ = [sum(q == e and a is not None and a <= x <= b for q, _, a, b in rows) for x in days]
        assert got[i] == pytest.approx(sum(1 / o for o in open_) / len(days))


def test_pinned_rank_and_guard(spark):
    df = spark.createDataFrame([(i, "q", float(v)) for i, v in enumerate([-2, -1, 0, 0, 3, 4, 5])] + [(90, "q", None), (91, "small", 1.0)], "i int, p string, v double")
    got = {r.i: r.v_rank for r in pn.cross_rank(df, ["i"], {"v": (0.0, 0.4)}, ["p"], guard=3).collect()}
    assert got[0] == 0.0 and got[1] == pytest.approx(0.4) and got[2] == got[3] == 0.4 and got[4] == pytest.approx(0.4) and got[6] == 1.0
    assert got[90] is None and got[91] is None


def test_dividend_streak(spark):
    rows = [(1, 0, 5.0, 4.0), (1, 1, 4.0, 10.0), (1, 2, 10.0, None), (1, 4, 0.0, None)]
    r = dividend_record(spark.createDataFrame(rows, "k int, off int, d double, prev_d double"), ["k"], "d").first()
    assert (r.years_known, r.years_paid, r.streak, r.cuts) == (4, 3, 3, 1)


def test_horizons_are_whole_years(spark):
    with pytest.raises(ValueError):
        sn.horizon_ends(spark.range(0).selectExpr("current_date() date"), spark.range(0).selectExpr("current_date() date", "1 ix"), (0,))


def test_registry():
    assert faults() == []
    assert "roa" in columns("profitability") and "f_score" not in rank_specs()
    assert faults(["x", "x"], {"x"}, {"x"}, set(), set()) == ["x stands twice"]
    assert faults(["x"], set(), {"x"}, {"y"}, {"z"}) == ["ranked: x", "pinned: y", "sector: z"]
