"""What the panel's ranks shuffle: every value once, and no part of the features."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import registry as reg
from tidemark.operators.asof import join_dealt
from tidemark.operators.panel import PART, cross_rank
from tidemark.plans import wide
from tidemark.plans.queries import World

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def exchanges(df) -> list[str]:
    """Shuffles of the plan; repeated subplans show the same one each time, as they are reused when they run."""
    return [x.strip() for x in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n") if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]


def test_ranks_of_many_columns_cost_one_shuffle(spark):
    names = [f"c{i}" for i in range(2 * PART + 3)]
    df = spark.range(60).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 3).alias("h"), *[(F.col("id") * (i + 1) % 17).cast("double").alias(n) for i, n in enumerate(names)])
    for deal in (None, ["g"]):
        out = cross_rank(df, ["id"], dict.fromkeys(names), ["g", "h"], 1, deal=deal, values=True)
        got = {r.id: r for r in out.collect()}
        assert out.columns == ["id", *[c for n in names for c in (n, f"{n}_rank")]]
        assert len(exchanges(out)) == 1
        for i, n in enumerate(names):
            for k in range(60):
                group = [j * (i + 1) % 17 for j in range(60) if (j % 2, j % 3) == (k % 2, k % 3)]
                assert got[k][n] == k * (i + 1) % 17 and got[k][f"{n}_rank"] == sum(x < k * (i + 1) % 17 for x in group) / (len(group) - 1)


def test_join_dealt_is_an_equi_join(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, None, "z"), (2, 1, "u"), (None, 1, "v")], "e int, d int, a string")
    b = spark.createDataFrame([(1, 1, 7), (1, 1, 8), (1, None, 9), (2, 2, 10), (None, 1, 11)], "e int, d int, b int")
    for how in ("inner", "left"):
        got, want = join_dealt(a, b, ["e"], ["d"], how), a.join(b, ["e", "d"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
def test_no_part_of_the_features_is_shuffled(spark):
    """Snapshots, prices and filings lie by entity; only the columns that are ranked are dealt out, by quarter."""
    filed = ["roa", "revenue_growth_1y", "revenue_trend_8q", "earnings_yield_vs_5y_median"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for used, most in ((["vol_36m", "mom_12_2", *filed], before), (filed, "-1")):  # the latter as of large tables; the benchmark's lines would be joined with the suppliers then
            assert set(used) <= set(reg.rank_specs())
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            f = wide.Features(World(spark, SF), wide.SPARSE)
            dealt = {x.split("hashpartitioning(")[1].split("#")[0] for x in exchanges(wide.ranks(wide.as_stored(f.all(used)), used))}
            assert not dealt & {"entity", "kind", "datekey", "__by_entity"} and "quarter" in dealt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
