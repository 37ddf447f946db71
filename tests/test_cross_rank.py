"""Ranks of many columns: results against loops, and arrays of columns in the shuffles instead of a row a value."""

import random

from pyspark.sql import functions as F

from tidemark.operators.panel import PART, cross_rank


def test_many_columns(spark):
    rnd = random.Random(1)
    names = [f"c{i}" for i in range(2 * PART + 3)]
    specs = {n: ((0.0, 0.25) if i % 4 == 1 else None) for i, n in enumerate(names)}
    rows = [(k, k % 2, *[rnd.choice([None, float(rnd.randint(-3, 3))]) if i else None for i in range(len(names))]) for k in range(30)]
    df = spark.createDataFrame(rows, "k int, g int, " + ", ".join(f"{n} double" for n in names))
    out = cross_rank(df, ["k"], specs, ["g"], guard=5)
    got = {r.k: r for r in out.collect()}
    assert sorted(got) == list(range(30)) and out.columns == ["k", *[f"{n}_rank" for n in names]]
    sign = lambda x: (x > 0) - (x < 0)
    for k, g, *vs in rows:
        for i, (n, v) in enumerate(zip(names, vs, strict=True)):
            group = [r[2 + i] for r in rows if r[1] == g and r[2 + i] is not None]
            want = None
            if v is not None and len(group) >= 5:
                side = [x for x in group if specs[n] is None or sign(x) == sign(v)]
                pr = sum(x < v for x in side) / (len(side) - 1) if len(side) > 1 else 0.0
                want = pr if specs[n] is None else 0.25 if v == 0 else pr * 0.25 if v < 0 else 0.25 + 0.75 * pr
            assert got[k][f"{n}_rank"] == want


def test_no_shuffle_has_a_row_a_value(spark):
    names = [f"c{i}" for i in range(2 * PART)]
    df = spark.range(10).select("id", (F.col("id") % 2).alias("g"), *[F.col("id").cast("double").alias(n) for n in names])
    plan = cross_rank(df, ["id"], dict.fromkeys(names), ["g"], 1)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert exchanges and not any(" f#" in x or "(f#" in x for x in exchanges)
