"""Statistics over bands of days, read from running states at both ends of a band.

A band of n days at ``at`` holds the series rows with ``at - n < ix <= at``.
Its sums are differences of two running sums, its last value is a running
struct.  Its maximum comes from two states as well: the axis is cut into blocks
of n days, a band touches two of them at most, and the maximum is that of the
later part of the first (running backwards) and the earlier part of the second
(running forwards).  Medians, of short bands only, read the rows of the two
blocks as arrays.  So a band costs the same however long it is, and no row of
the series meets an ask.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.asof import join_dealt


def band_stats(
    asks: DataFrame,
    series: DataFrame,
    by: list[str],
    at: str,
    ix: str,
    measures: dict[str, Column],
    sums: dict[str, Iterable[int]] | None = None,
    maxima: dict[str, Iterable[int]] | None = None,
    last: dict[str, Iterable[tuple[int, int]]] | None = None,
    medians: dict[str, Iterable[int]] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """One row for each distinct (by, at) of ``asks``, with statistics of ``measures`` of ``series`` over bands of days.

    ``sums`` {m: days} gives m_sum_n (null without values) and m_n_n (how many
    aren't null), ``maxima`` m_max_n, ``medians`` m_med_n, and ``last``
    {m: (lo, hi)} gives m_last_lo_hi, the value in the newest row with
    lo <= at - ix <= hi, null where that is.  A sum is a difference of running
    ones, exact for whole numbers; NaN counts as null, as it would spoil all
    that follows.

    ``ix`` and ``at`` are whole numbers.  Rows of either side whose place is
    null are left out; a null key is a key; repeated rows of the series count
    again (of several at the last place an arbitrary one is taken); asks
    without any row get nulls and counts of 0.  One shuffle by the key carries
    both sides, and the rows of a key are sorted in one task, which suits axes
    of days; only ``medians`` take further shuffles, and hold a band's rows.  A
    null key has no medians.  ``dealt`` says that both sides lie by the key
    already (bucketed), so that nothing is shuffled.
    """
    sums, maxima, last, medians = ({m: sorted(set(x)) for m, x in (d or {}).items()} for d in (sums, maxima, last, medians))
    kinds = dict(series.select(*[e.alias(m) for m, e in measures.items()]).dtypes)
    clean = lambda m, e: F.when(~F.isnan(e), e) if kinds[m] in ("double", "float") else e
    place = lambda c: F.col(c).cast("long").alias("__ix")
    told = series.where(F.col(ix).isNotNull())
    points = asks.where(F.col(at).isNotNull()).select(*by, place(at)).distinct()
    used = list(dict.fromkeys([*sums, *maxima, *last]))
    # keys under names of their own, as Spark doesn't see that a union of catalog tables still lies by columns of theirs
    keys = {f"__by_{c}": F.col(c) for c in by}
    rows = told.select(*[c.alias(k) for k, c in keys.items()], *[c for c in series.columns if c not in by], place(ix), F.lit(True).alias("__print"))
    rows = rows.unionByName(points.select(*[c.alias(k) for k, c in keys.items()], "__ix", F.lit(False).alias("__print")), allowMissingColumns=True)
    # measures are made where rows were dealt out to, so that only the columns that they come from are shuffled
    rows = rows.repartition(*keys) if by and not dealt else rows
    rows = rows.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "__ix", "__print", *[F.when(F.col("__print"), clean(m, measures[m])).alias(f"__m_{m}") for m in used])
    # frames grow with the rows, so each row enters each of them once; the frame up to p days back ends at the band's start
    up = Window.partitionBy(*by).orderBy("__ix")
    upto = lambda c, p: c.over(up.rangeBetween(Window.unboundedPreceding, -p))
    down = Window.partitionBy(*by).orderBy(F.desc("__ix"))
    block = lambda n, c="__ix": F.floor(F.col(c) / n).cast("long")
    late: dict[str, Column] = {}
    early: dict[str, Column] = {}
    for m, x in maxima.items():
        for n in x:
            of = lambda b, m=m: F.max(F.when(F.col(f"__m_{m}").isNotNull(), F.struct(b.alias("b"), F.col(f"__m_{m}").alias("v"))))
            late[f"__f_{m}_{n}"] = upto(of(block(n)), 0)
            early[f"__b_{m}_{n}"] = of(-block(n)).over(down.rangeBetween(Window.unboundedPreceding, n - 1))
    for m, x in sums.items():
        for n in (0, *x):
            late |= {f"__s_{m}_{n}": upto(F.sum(f"__m_{m}"), n), f"__n_{m}_{n}": upto(F.count(f"__m_{m}"), n)}
    for m, x in last.items():
        for lo in {lo for lo, _ in x}:
            late[f"__z_{m}_{lo}"] = upto(F.last(F.when(F.col("__print"), F.struct(F.col("__ix").alias("ix"), F.col(f"__m_{m}").alias("v"))), ignorenulls=True), lo)
    read = (rows.withColumns(early) if early else rows).withColumns(late).where(~F.col("__print"))
    out: dict[str, Column] = {}
    for m, x in sums.items():
        for n in x:
            count = F.col(f"__n_{m}_0") - F.col(f"__n_{m}_{n}")
            out |= {f"{m}_n_{n}": count, f"{m}_sum_{n}": F.when(count > 0, F.col(f"__s_{m}_0") - F.coalesce(F.col(f"__s_{m}_{n}"), F.lit(0)))}
    for m, x in last.items():
        for lo, hi in x:
            hit = F.col(f"__z_{m}_{lo}")
            out[f"{m}_last_{lo}_{hi}"] = F.when(hit["ix"] >= F.col("__ix") - hi, hit["v"])
    for m, x in maxima.items():
        for n in x:
            end, start = F.col(f"__f_{m}_{n}"), F.col(f"__b_{m}_{n}")
            begins = F.floor((F.col("__ix") - (n - 1)) / n).cast("long")
            out[f"{m}_max_{n}"] = F.greatest(F.when(end["b"] == block(n), end["v"]), F.when(-start["b"] == begins, start["v"]))
    done = read.select(*by, F.col("__ix").alias(at), *[c.alias(k) for k, c in out.items()])
    for m, x in medians.items():
        for n in x:
            prints = told.select(*by, place(ix), clean(m, measures[m]).alias(f"__m_{m}"))
            med = _medians(points, prints, by, m, n, dealt).withColumnRenamed("__ix", at)
            done = join_dealt(done, med, by, [at], "left") if dealt else done.join(med, [*by, at], "left")
    return done


def _medians(points: DataFrame, prints: DataFrame, by: list[str], m: str, n: int, dealt: bool = False) -> DataFrame:
    """Medians of the bands of ``n`` days: the two blocks of a band as arrays, cut to it, put together and sorted."""
    block = lambda c: F.floor(c / n).cast("long")
    held = prints.where(F.col(f"__m_{m}").isNotNull()).groupBy(*by, block(F.col("__ix")).alias("__b")).agg(F.collect_list(F.struct(F.col("__ix").alias("ix"), F.col(f"__m_{m}").alias("v"))).alias("__l"))
    two = points.withColumn("__b", F.explode(F.array_distinct(F.array(block(F.col("__ix") - (n - 1)), block(F.col("__ix"))))))
    near = F.filter("__l", lambda s: (s["ix"] > F.col("__ix") - n) & (s["ix"] <= F.col("__ix")))
    met = (join_dealt(two, held, by, ["__b"]) if dealt else two.join(held, [*by, "__b"])).select(*by, "__ix", F.transform(near, lambda s: s["v"]).alias("__v"))
    v = F.array_sort(F.flatten(F.collect_list("__v")))
    wide = met.groupBy(*by, "__ix").agg(v.alias("__v"))
    size, middle = F.size("__v"), lambda k: F.get("__v", k.cast("int"))
    median = F.when(size > 0, (middle(F.floor((size - 1) / 2)) + middle(F.floor(size / 2))) / F.lit(2.0))
    return wide.select(*by, "__ix", median.alias(f"{m}_med_{n}"))


def spread(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares; null below two values."""
    return F.when(n > 1, F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1)))


def slope(n: Column, x: Column, y: Column, xy: Column, xx: Column) -> Column:
    """Slope of y over x from sums; null where x doesn't vary (beyond rounding)."""
    varies = n * xx - x * x
    return F.when((n > 1) & (varies > 1e-12 * n * xx), (n * xy - x * y) / varies)
