"""What was known at a date about a period: filings have a period and the day from which they were known.

``versions`` turns filings into versions of lagged periods: for every period
t0 that is asked about and every lag, the filings near the lagged period, each
known from its day until the next one.  How many there are grows with filings
and lags, not with the dates asked at.  ``lagged_asof`` then takes one as-of
step for each (row, lag): no row meets all filings of its entity.

Rows that are dated by as-of filings need less: nothing is filed between a date
and the newest filing known at it, so what is known is what was known on that
filing's day.  ``lagged_at_filing`` says so once for each such day, however
many rows look back on it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.asof import asof_join

SLACK = 30  # days that a period may lie off the lagged one


def versions(periods: DataFrame, filings: DataFrame, values: list[str], lags: Iterable[int], spacing: float, slack: int = SLACK) -> DataFrame:
    """(entity, t0, lag, known_from, known_to, period, values): what is known about ``lag`` spacings before each t0 of ``periods`` (entity, t0).

    ``filings`` have entity, datekey (known from), reportperiod and ``values``.
    A filing is near lag k if its period lies at t0 - k * ``spacing`` days,
    give or take ``slack``, but not after t0.  A version holds from its day
    until the day of the next one (null: still); of several on one day the
    newest period counts.  Lags must be further apart than twice the slack, so
    that a period is near one of them only.  Filings meet periods by day
    buckets of an entity.  Rows without entity, day or period are left out.
    """
    if spacing <= 2 * slack:
        raise ValueError(f"lags of {spacing} days overlap with {slack} days of slack")
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    width = 2 * slack + 1
    bucket = lambda c: F.floor(c / width).cast("long")
    asked = periods.select("entity", "t0").where("entity is not null and t0 is not null").distinct().withColumn("__t", day(F.col("t0")))
    f = filings.where("datekey is not null and reportperiod is not null").select("entity", F.col("datekey").alias("known_from"), F.col("reportperiod").alias("period"), *values)
    f = f.withColumn("__p", day(F.col("period"))).withColumn("lag", F.explode(F.array(*[F.lit(int(k)) for k in lags])))
    at = F.col("__p") + F.col("lag") * F.lit(float(spacing))
    f = f.withColumn("__b", F.explode(F.array_distinct(F.array(bucket(at - slack), bucket(at + slack)))))
    gap = F.col("__t") - F.col("__p")
    near = (gap >= 0) & (F.abs(gap - F.col("lag") * F.lit(float(spacing))) <= slack)
    met = asked.withColumn("__b", bucket(F.col("__t"))).join(f, ["entity", "__b"]).where(near)
    newest = met.groupBy("entity", "t0", "lag", "known_from").agg(F.max(F.struct("period", *values)).alias("__v"))
    until = F.lead("known_from").over(Window.partitionBy("entity", "t0", "lag").orderBy("known_from"))
    return newest.select("entity", "t0", "lag", "known_from", until.alias("known_to"), "__v.*")


def lagged_asof(base: DataFrame, filings: DataFrame, key: list[str], values: list[str], lags: Iterable[int], spacing: float, slack: int = SLACK, allow_exact: bool = False) -> DataFrame:
    """(key, lag, known_from, period, values) known before each row's date (at it, with ``allow_exact``), one row at most for a (row, lag).

    ``base`` has ``key`` (with entity and date) and reportperiod, the period t0
    that lags count from; rows without one give nothing.
    """
    lags = list(lags)
    rows = base.select(*key, F.col("reportperiod").alias("t0")).where("t0 is not null")
    known = versions(rows, filings, values, lags, spacing, slack)
    asks = rows.withColumn("lag", F.explode(F.array(*[F.lit(int(k)) for k in lags])))
    hit = asof_join(asks, known, ["entity", "t0", "lag"], "date", "known_from", ["period", *values], how="inner", allow_exact=allow_exact)
    return hit.select(*key, "lag", "known_from", "period", *values)


def lagged_at_filing(filings: DataFrame, values: list[str], lags: Iterable[int], spacing: float, slack: int = SLACK) -> DataFrame:
    """(entity, datekey, lag, known_from, period, values): what was known on each day on which an entity filed, one row at most for a (day, lag).

    Lags count from the newest period filed that day; which filings are near
    one and which counts is as in ``versions``.  A day meets the filings of its
    entity up to it.  Rows without entity, day or period are left out.
    """
    if spacing <= 2 * slack:
        raise ValueError(f"lags of {spacing} days overlap with {slack} days of slack")
    days = filings.where("entity is not null and datekey is not null").groupBy("entity", "datekey").agg(F.max("reportperiod").alias("__t0")).where("__t0 is not null")
    told = filings.where("datekey is not null and reportperiod is not null").select("entity", F.struct(F.col("datekey").alias("known_from"), F.col("reportperiod").alias("period"), *values).alias("__v"))
    gap = F.datediff("__t0", F.col("__v.period"))
    lag = F.floor(gap / F.lit(float(spacing)) + 0.5).cast("int")  # the only one that can be near, as lags don't overlap
    near = (F.col("__v.known_from") <= F.col("datekey")) & (gap >= 0) & lag.isin([int(k) for k in lags]) & (F.abs(gap - lag * F.lit(float(spacing))) <= slack)
    met = days.join(told, "entity").where(near).select("entity", "datekey", lag.alias("lag"), "__v")
    return met.groupBy("entity", "datekey", "lag").agg(F.max("__v").alias("__v")).select("entity", "datekey", "lag", "__v.*")
