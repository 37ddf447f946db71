"""Spans of prices from arrays: results against loops, entities cut by batches, and steps that once multiplied rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import quality_reports as qr
from tidemark.operators import snapshots as sn

DAY = dt.date(2020, 1, 1)


def test_spans_against_loops(spark):
    rnd = random.Random(3)
    days = [DAY + dt.timedelta(days=i) for i in range(60)]
    cal = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "date date, ix int")
    px = {e: {i: float(rnd.randint(1, 9)) for i in sorted(rnd.sample(range(10, 60), 25))} for e in range(7)}
    asks = [(e, f"k{n}", days[i], px[e][i], [(h, days[j], j + 1) for h, j in ((1, min(i + 3, 59)), (2, 59))] if n else None) for e in px for n, i in enumerate(list(px[e])[:5])]
    asks.append((99, "k", days[0], 1.0, [(1, days[5], 6)]))  # an entity without prints
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11)  # entities go on in the next batch
    try:
        prices = spark.createDataFrame([(e, days[i], p) for e in px for i, p in px[e].items()], "entity int, date date, close double")
        ask = spark.createDataFrame(asks, "entity int, kind string, date date, entry double, ends array<struct<h: int, end_date: date, end_ix: int>>")
        got = {(r.entity, r.date): r.spans for r in sn.span_stats(prices, cal, ask, 6).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(asks)
    for e, _, d, entry, ends in asks:
        spans = {x.h: x for x in got[e, d]}
        assert sorted(spans) == [h for h, *_ in ends or []]
        for h, end_date, end in ends or []:
            p, i = px.get(e, {}), (d - DAY).days
            carried = [p[max(x for x in p if x <= j)] for j in range(end - 6, end) if j >= 0 and any(x <= j for x in p)]
            x = spans[h]
            assert x.end_date == end_date
            if not carried:
                assert x.last_end is None and x.max_drawdown is None
                continue
            path = [p[j] for j in sorted(p) if i <= j < end]
            want = (sum(carried) / len(carried), min(carried), max(carried), carried[-1], max(1 - b / a for k, a in enumerate(path) for b in path[k:]), max(0.0, 1 - min(path) / entry))
            assert all(abs(a - b) < 1e-12 for a, b in zip((x.avg_end, x.min_end, x.max_end, x.last_end, x.max_drawdown, x.fall_from_entry), want, strict=True))


def test_drawdown_has_no_row_for_each_quarter_of_a_span(spark):
    p = spark.createDataFrame([(1, DAY, 2.0)], "entity int, date date, close double")
    spans = spark.createDataFrame([(1, "k", DAY, 2.0, 1, DAY)], "entity int, kind string, date date, entry double, h int, end_date date")
    plan = sn.max_drawdown(p, spans)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") <= 2  # both with the calendar


def test_distances_are_compiled(spark):
    sp = spark.createDataFrame([(1, 1, 0.0, 1.0), (2, 1, 1.0, 1.0)], "e int, q int, x double, y double").withColumn("q", F.lit(DAY))
    near = qr.nearest_neighbours(sp, sp, ["x", "y"], "e", "q")
    assert "lambda" not in near._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.s_e, r.t_e, r.d2) for r in near.collect()) == [(1, 2, 1.0), (2, 1, 1.0)]


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]


def test_lines_are_dealt_out_twice_for_prices_and_summed_first_for_filings(spark):
    from tidemark.sources import binding as bind

    sf = "/root/testdata/sf0.001"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where suppliers are many
    try:
        # lines by entity and by ticker; suppliers for either join
        assert len(_exchanges(bind.prices(spark, sf))) == 4
        plan = bind.full_filings(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join LeftSemi") < plan.index("Aggregate")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_band_measures_are_made_behind_the_shuffle(spark):
    from tidemark.operators.bands import band_stats

    series = spark.createDataFrame([(1, i, float(i)) for i in range(5)], "e int, ix int, p double")
    asks = spark.createDataFrame([(1, 4)], "e int, at int")
    measures = {"a": F.col("p"), "b": F.col("p") * 2, "one": F.lit(1)}
    got = band_stats(asks, series, ["e"], "at", "ix", measures, {m: [3] for m in measures})
    assert [(r.a_sum_3, r.b_sum_3, r.one_sum_3, r.one_n_3) for r in got.collect()] == [(9.0, 18.0, 3, 3)]
    plan = band_stats(asks, series, ["e"], "at", "ix", measures, {m: [3] for m in measures})._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = next(i for i, x in enumerate(plan) if "RepartitionByExpression" in x)
    assert any("__m_b" in x for x in plan[:dealt]) and not any("__m_b" in x for x in plan[dealt:])


def test_a_query_makes_its_prices_once(spark, monkeypatch):
    from tidemark.plans import queries as q

    made, prices = [], q.bind.prices
    monkeypatch.setattr(q.bind, "prices", lambda *a: made.append(1) or prices(*a))
    q.QUERIES["assembled_panel"](spark, "/root/testdata/sf0.001")
    assert len(made) == 1
