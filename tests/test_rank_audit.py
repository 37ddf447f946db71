"""Ranks and their audit in Arrow batches: groups over batches and files, and counts that go on instead of rows."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tidemark.operators import cross_sections
from tidemark.operators.panel import audit_detail, cross_rank, rank_audit, rank_audit_detail, tie_audit
from tidemark.plans.wide import as_stored

SPECS = {"a": None, "b": (0.0, 0.25), "c": None, "d": (1.0, 0.5), "e": None}


def panel(spark, n=700, seed=3):
    rnd = random.Random(seed)
    value = lambda i: rnd.choice([None, float("nan"), float("inf"), -0.0, 0.0, 1.0, *[float(rnd.randint(-9, 9))] * 9]) if i else None
    rows = [(k, rnd.choice(["1998-01-01", "1998-04-01", "1998-07-01", None]), rnd.choice(["low", "high", None]), *[value(i) for i in range(4)], float(k % 129)) for k in range(n)]
    return spark.createDataFrame(rows, "k int, q string, kind string, " + ", ".join(f"{c} double" for c in SPECS)).withColumn("q", F.col("q").cast("date")), rows


def plain(rows, guard):
    """(k, column): rank."""
    out = {}
    for i, (name, pin) in enumerate(SPECS.items()):
        for g in {r[1:3] for r in rows}:
            vs = [(r[0], r[3 + i]) for r in rows if r[1:3] == g and r[3 + i] is not None]
            nan = lambda v: v != v
            side = lambda v: 0 if pin is None else 3 if nan(v) else (v > pin[0]) - (v < pin[0])  # noqa: E731, B023
            for k, v in vs if len(vs) >= guard else []:
                peers = [x for _, x in vs if side(x) == side(v)]
                r = sum(not nan(x) and (nan(v) or x < v) for x in peers) / (len(peers) - 1) if len(peers) > 1 else 0.0
                out[k, name] = r if pin is None else pin[1] if side(v) == 0 else r * pin[1] if side(v) == -1 else pin[1] + (1 - pin[1]) * r
    return out


def test_groups_over_batches_and_files(spark, monkeypatch):
    df, rows = panel(spark)
    want = plain(rows, 20)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, held in ((before, 1 << 26), ("7", 1 << 26), ("7", 1), ("7", 999)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            monkeypatch.setattr(cross_sections, "HELD", held)
            got = cross_rank(df, ["k"], SPECS, ["q", "kind"], deal=["q"], values=True).collect()
            assert sorted(r.k for r in got) == list(range(len(rows)))
            for r in got:
                for i, c in enumerate(SPECS):
                    v = rows[r.k][3 + i]
                    assert r[f"{c}_rank"] == want.get((r.k, c)) and (r[c] == v or v != v and r[c] != r[c])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_audit_of_ranks_is_that_of_the_ranked_table(spark, monkeypatch):
    df = as_stored(panel(spark)[0])
    ranked = as_stored(cross_rank(df, ["k"], SPECS, ["q", "kind"])).join(df, "k")
    names = [f"{c}_rank" for c in SPECS]
    rows = lambda x: sorted(str(r) for r in x.collect())
    for held in (1 << 26, 1):
        monkeypatch.setattr(cross_sections, "HELD", held)
        assert rows(rank_audit(df, SPECS, "q", "kind")) == rows(tie_audit(ranked, names, "q", "kind"))
        detail = rows(rank_audit_detail(df, SPECS, "q", "kind", k=3))
        assert detail and detail == rows(audit_detail(ranked, {n: n.removesuffix("_rank") for n in names}, "q", "kind", k=3))


def test_only_counts_leave_the_task_that_ranks(spark):
    """700 rows of 5 columns have some 20 ranks a group and column; the values themselves are shuffled once."""
    df, _ = panel(spark)
    plan = rank_audit(df, SPECS, "q", "kind")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(q#") == 1 and "Generate" not in plan and "Join" not in plan


def test_rounding_is_that_of_spark(spark):
    rnd = random.Random(5)
    xs = [k / (n - 1) for n in (65, 129, 641, 1281, 12801, 64001) for k in range(0, n, max(1, n // 300))] + [rnd.random() for _ in range(3000)] + [round(rnd.random(), 6) + 5e-7 for _ in range(3000)]
    got = cross_sections._rounder()(__import__("numpy").array(xs))
    want = [r.x for r in spark.createDataFrame([(x,) for x in xs], "x double").select(F.round("x", 6).alias("x")).collect()]
    assert got.tolist() == want == [float(Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) for x in xs]
