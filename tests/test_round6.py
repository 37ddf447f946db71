import random

from pyspark.sql import functions as F

from tidemark.functions.exprs import round6


def test_as_spark_rounds(spark):
    rnd = random.Random(1)
    near = [s * (round(rnd.random() * 10**e, 6) + 5e-7) for e in (0, 1, 3, 4, 5, 6) for s in (1, -1) for _ in range(300)]
    xs = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 5e-324, 99999.9999995, 100000.0000005, -2.5e-7, *near, *[k / (n - 1) for n in (65, 129, 12801) for k in range(0, n, 7)], *[rnd.gauss(0, 1) * 10 ** rnd.randint(-9, 12) for _ in range(3000)]]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select(round6(F.col("x")).alias("got"), (F.round("x", 6) + F.lit(0.0)).alias("want")).collect()
    assert [str(r.got) for r in rows] == [str(r.want) for r in rows]


def test_most_numbers_make_no_digits(spark):
    """The decimal rounding stands in one branch of the expression only."""
    plan = spark.range(1).select(round6(F.col("id").cast("double")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == 1 and "CASE WHEN" in plan
