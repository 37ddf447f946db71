"""Carried prices as runs: a price holds from its day until the day before the next print.

A path of n days is some runs cut to its first and last day, so sums, extremes
and the value of a day need no row a day; days are made where they are asked
for only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 32  # places of the axis that share a join key


def price_runs(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """(entity, from_ix, to_ix, price, is_extension): runs of the calendar's places in which a price is the last one.

    After the last print its price goes on to the calendar's end, as a run of
    its own with ``is_extension``.  Rows without a price make no run; before the
    first print there is none.
    """
    end = calendar.agg(F.max("ix").alias("__end"))
    order = Window.partitionBy("entity").orderBy("ix")
    p = prices.where("close is not null").join(F.broadcast(calendar), "date").select("entity", F.col("ix").cast("long").alias("ix"), "close").crossJoin(F.broadcast(end))
    p = p.withColumn("__next", F.lead("ix").over(order))
    own = F.struct(F.col("ix").alias("from_ix"), F.coalesce(F.col("__next") - 1, F.col("ix")).alias("to_ix"), F.col("close").alias("price"), F.lit(False).alias("is_extension"))
    more = F.struct((F.col("ix") + 1).alias("from_ix"), F.col("__end").cast("long").alias("to_ix"), F.col("close").alias("price"), F.lit(True).alias("is_extension"))
    last = F.col("__next").isNull() & (F.col("ix") < F.col("__end"))
    return p.select("entity", F.inline(F.when(last, F.array(own, more)).otherwise(F.array(own))))


def paths(asks: DataFrame, runs: DataFrame, key: list[str], start: str = "start_ix", end: str = "end_ix") -> DataFrame:
    """(key, from_ix, to_ix, price, is_extension): the runs of each ask's entity, cut to [start, end].

    Asks and runs meet by entity and stretches of ``WIDTH`` places; a pair that
    shares several is kept in the first.  An ask before the first print has no
    row; ``key`` (with entity) names an ask.
    """
    stretch = lambda c: F.floor(F.col(c) / WIDTH).cast("long")
    each = lambda a, b: F.explode(F.sequence(stretch(a), stretch(b)))
    a = asks.where(F.col(start) <= F.col(end)).select(*key, F.col(start).cast("long").alias("__a"), F.col(end).cast("long").alias("__z")).withColumn("__b", each("__a", "__z"))
    r = runs.withColumn("__b", each("from_ix", "to_ix"))
    met = a.join(r, ["entity", "__b"]).where((F.col("from_ix") <= F.col("__z")) & (F.col("to_ix") >= F.col("__a")) & (F.col("__b") == F.greatest(stretch("from_ix"), stretch("__a"))))
    return met.select(*key, F.greatest("from_ix", "__a").alias("from_ix"), F.least("to_ix", "__z").alias("to_ix"), "price", "is_extension")


def path_stats(path: DataFrame, key: list[str]) -> DataFrame:
    """key, n_days, avg_price (each day counts), min_price, max_price, last_price, n_extension."""
    days = F.col("to_ix") - F.col("from_ix") + 1
    return path.groupBy(*key).agg(
        F.sum(days).alias("n_days"), (F.sum(F.col("price") * days) / F.sum(days)).alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.max_by("price", "to_ix").alias("last_price"), F.coalesce(F.sum(F.when(F.col("is_extension"), days)), F.lit(0)).alias("n_extension"),
    )


def path_days(path: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each day of each run, with its ``ix`` and date ``day``."""
    keep = [c for c in path.columns if c not in ("from_ix", "to_ix")]
    days = path.select(*keep, F.explode(F.sequence("from_ix", "to_ix")).alias("ix"))
    return days.join(F.broadcast(calendar.select(F.col("ix").cast("long").alias("ix"), F.col("date").alias("day"))), "ix").select(*keep, "ix", "day")
