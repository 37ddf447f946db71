"""Uniqueness weights: against a count of days, and without joins that a small table's size could turn into broadcasts."""

import os
import random
from datetime import date, timedelta

import pytest

from tidemark.operators.panel import uniqueness_weights
from tidemark.plans.queries import World, _weights

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_against_days(spark):
    rnd = random.Random(2)
    day = lambda n: date(1998, 1, 1) + timedelta(n)
    rows = []
    for k in range(120):
        lo = rnd.randint(0, 40)
        rows.append((k, k % 3, day(lo), day(lo + rnd.randint(-2, 30))) if k % 10 else (k, k % 3, None if k % 20 else day(lo), None))
    df = spark.createDataFrame(rows, "k int, g int, a date, b date")
    good = [r for r in rows if r[2] and r[3] and r[2] <= r[3]]
    got = {r.k: r.weight for r in uniqueness_weights(df, "g", "a", "b", ["g", "k"]).collect()}
    assert sorted(got) == list(range(120))
    for k, g, a, b in rows:
        if (k, g, a, b) not in good:
            assert got[k] is None
            continue
        days = [a + timedelta(i) for i in range((b - a).days + 1)]
        want = sum(1 / sum(x[1] == g and x[2] <= d <= x[3] for x in good) for d in days) / len(days)
        assert abs(got[k] - want) < 1e-9


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
def test_nothing_is_joined_or_shuffled(spark):
    """Only the last day of the calendar, one row, is broadcast, however small the others look."""
    plan = _weights(World(spark, SF))._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "HashJoin" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastExchange") == 1
