"""As-of, validity-window and band joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window



def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, carry: list[str], how: str = "left", allow_exact: bool = True, tolerance_days: int | None = None) -> DataFrame:
    """For each left row the newest right row with right_on <= left_on (< without ``allow_exact``).

    Both sides are put together and sorted once within the key; the last right
    row seen is carried forward as one struct.  One shuffle, no fan-out.
    ``right`` must be unique per (by, right_on).  The result has the columns of
    ``left``, ``right_on`` and ``carry``.  Rows whose left_on is null match
    nothing; a null key matches a null key.
    """
    names = left.columns
    packed = F.struct(F.col(right_on).alias(right_on), *[F.col(c).alias(c) for c in carry])
    # under names of their own, as Spark doesn't see that a union of catalog tables still lies by columns of theirs
    keys = [f"__by_{c}" for c in by]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    rows = left.select(*named, F.col(left_on).alias("__t"), F.lit(1 if allow_exact else 0).alias("__side"), F.struct(*[c for c in names if c not in by]).alias("__left"))
    rows = rows.withColumn("__right", F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType))
    facts = right.where(F.col(right_on).isNotNull()).select(*named, F.col(right_on).alias("__t"), F.lit(0 if allow_exact else 1).alias("__side"), F.lit(None).cast(rows.schema["__left"].dataType).alias("__left"), packed.alias("__right"))
    w = Window.partitionBy(*keys).orderBy(F.col("__t").asc_nulls_first(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.unionByName(facts).withColumn("__hit", F.last("__right", ignorenulls=True).over(w)).where(F.col("__left").isNotNull())
    if tolerance_days is not None:
        out = out.withColumn("__hit", F.when(F.datediff("__t", F.col(f"__hit.{right_on}")) <= tolerance_days, F.col("__hit")))
    if how == "inner":
        out = out.where(F.col("__hit").isNotNull())
    return out.select(*[F.col(f"__by_{c}").alias(c) if c in by else F.col(f"__left.{c}") for c in names], *[F.col(f"__hit.{c}").alias(c) for c in [right_on, *carry]])


def join_dealt(left: DataFrame, right: DataFrame, by: list[str], same: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``by`` and ``same`` that deals rows out by ``by`` only, with the columns of ``left`` and the others of ``right``.

    ``same`` is compared by two bounds: were it a key of the join, Spark would
    deal both sides out by all keys, even if they lie by ``by`` already.  A row
    meets all rows of its ``by``, so these should be few (an entity's days).
    """
    keys = [*by, *same]
    r = right.select(*[F.col(c).alias(f"__{c}") for c in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in by] + [(F.col(c) <= F.col(f"__{c}")) & (F.col(c) >= F.col(f"__{c}")) for c in same])
    return left.join(r, on, how).drop(*[f"__{c}" for c in keys])


def validity_join(facts: DataFrame, mapping: DataFrame, key: str, at: str, start: str, end: str, entity: str, grace_before: int = 0, grace_after: int = 0, nearest: bool = False, flag: str | None = None, fact_id: list[str] | None = None) -> DataFrame:
    """Facts with the entity whose window [start, end] holds ``at``; an open end is unbounded.

    Grace days widen the windows of reused keys (``flag``).  ``nearest`` keeps
    one entity for each fact (named by ``fact_id``): the one with the smallest
    distance to its window, then the smallest entity.
    """
    m = mapping.select(F.col(key).alias("__key"), F.col(entity).alias(entity), F.col(start).alias("__from"), F.col(end).alias("__to"), (F.col(flag) if flag else F.lit(True)).alias("__reused"))
    inside = (F.coalesce(F.date_sub("__from", grace_before), F.lit("0001-01-01").cast("date")) <= F.col(at)) & (F.coalesce(F.date_add("__to", grace_after), F.lit("9999-12-31").cast("date")) >= F.col(at))
    if flag:
        inside = inside | ~F.col("__reused")
    j = facts.join(m, (F.col(key) == F.col("__key")) & inside)
    if nearest:
        gap = F.greatest(F.coalesce(F.datediff("__from", F.col(at)), F.lit(0)), F.coalesce(F.datediff(F.col(at), "__to"), F.lit(0)), F.lit(0))
        w = Window.partitionBy(*(fact_id or facts.columns)).orderBy(gap, entity)
        j = j.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return j.select(*facts.columns, entity)


def band_join(left: DataFrame, right: DataFrame, by: list[str], left_ix: str, right_ix: str, lookback: int, right_cols: list[str]) -> DataFrame:
    """Right rows with right_ix in [left_ix - lookback, left_ix], by bucketed equi-join.

    The index axis is cut into buckets of ``lookback + 1``; a left row names
    the two buckets that its band can touch, so the join key is (by, bucket)
    and no key sees all rows of an entity.
    """
    width = lookback + 1
    bucket = lambda c: F.floor(c / width).cast("long")
    lefts = left.withColumn("__b", F.explode(F.array_distinct(F.array(bucket(F.col(left_ix)), bucket(F.col(left_ix) - lookback)))))
    rights = right.select(*by, F.col(right_ix).alias("__ix"), bucket(F.col(right_ix)).alias("__b"), *[F.col(c).alias(c) for c in right_cols])
    j = lefts.join(rights, [*by, "__b"]).where((F.col("__ix") <= F.col(left_ix)) & (F.col("__ix") >= F.col(left_ix) - lookback))
    return j.drop("__b").withColumnRenamed("__ix", right_ix if right_ix != left_ix else f"{right_ix}_r")


def latest_by(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """One row for each ``by``, the first in ``order``."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rn = 1").drop("__rn")
