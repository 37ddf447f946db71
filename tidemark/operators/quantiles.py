"""Exact quantiles by position: no task and no buffer holds a whole group.

Equal values are counted, the counted values are dealt out by ranges of
(group, value), and each range learns how many rows of its group lie before it
from one row a range.  So every value knows its place in the group, however
large that is, and a quantile is the value at a place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sources.io import materialized


def places(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n, before, total) for each distinct value that isn't null: its count, that of smaller ones, and the group's.

    NaN is the largest value; a null group is one.  A group with a third of all
    rows is spread over as many ranges as its values need.
    """
    rows = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    dealt = materialized(rows.repartitionByRange(*by, value).withColumn("__range", F.spark_partition_id()))
    parts = dealt.groupBy(*by, "__range").agg(F.sum("n").alias("__sum"))
    order = Window.partitionBy(*by).orderBy("__range")  # a row for each range that the group reaches into
    parts = parts.withColumn("__offset", F.coalesce(F.sum("__sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("__sum").over(Window.partitionBy(*by)))
    same = F.lit(True)
    for k in by:
        same &= F.col(f"d.{k}").eqNullSafe(F.col(f"p.{k}"))
    met = dealt.alias("d").join(parts.alias("p"), same & (F.col("d.__range") == F.col("p.__range"))).select("d.*", "p.__offset", "p.total")
    local = Window.partitionBy("__range", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return met.select(*by, value, "n", (F.col("__offset") + F.coalesce(F.sum("n").over(local), F.lit(0))).alias("before"), "total")


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float], discrete: bool = False) -> DataFrame:
    """by, n and a column for each of ``probs`` {name: p in [0, 1]}: the exact quantiles of ``value``; nulls don't count.

    Between two values a quantile is interpolated, or the smaller of them
    (the first value at which the share p is reached) if ``discrete``.  Groups
    without values have no row.
    """
    if not all(0 <= p <= 1 for p in probs.values()):
        raise ValueError("quantiles are asked for by shares between 0 and 1")
    p = materialized(places(df, by, value))
    picked: list[Column] = [F.max("total").alias("n")]
    needed = F.lit(False)
    at: dict[str, tuple[Column, Column, Column]] = {}
    for name, share in probs.items():
        if discrete:
            spot = F.greatest(F.ceil(F.lit(float(share)) * F.col("total")) - 1, F.lit(0)).cast("double")
        else:
            spot = F.lit(float(share)) * (F.col("total") - 1)
        lo = F.floor(spot).cast("long")
        at[name] = (lo, F.ceil(spot).cast("long"), spot - lo)
    for name, (lo, hi, part) in at.items():
        holds = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
        needed |= holds(lo) | holds(hi)
        picked += [F.max(F.when(holds(lo), F.col(value))).alias(f"__lo_{name}"), F.max(F.when(holds(hi), F.col(value))).alias(f"__hi_{name}"), F.max(part).alias(f"__part_{name}")]
    # two values a quantile and group are left
    few = p.where(needed)
    agg = few.groupBy(*by).agg(*picked) if by else few.agg(*picked).where("n is not null")
    between = lambda n: F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__part_{n}")
    return agg.select(*by, "n", *[(F.col(f"__lo_{n}") if discrete else F.when(F.col(f"__part_{n}") == 0, F.col(f"__lo_{n}").cast("double")).otherwise(between(n))).alias(n) for n in probs])
