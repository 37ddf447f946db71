"""Trading calendar, touch-date snapshots, horizons and forward labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import add_years
from tidemark.operators.asof import asof_join

KINDS = ("median", "low", "high")
HORIZONS = (1, 2, 3, 5)  # years
CAGR_PCT, EXCESS_PCT = (0, 5, 8, 10, 15, 20), (5, 10)  # thresholds of the flags


def trading_calendar(prices: DataFrame) -> DataFrame:
    """date, ix: dense index over the distinct dates (some thousand rows; one partition numbers them)."""
    return prices.select("date").distinct().withColumn("ix", F.row_number().over(Window.orderBy("date")))


def touch_snapshots(prices: DataFrame) -> DataFrame:
    """Three rows per (entity, quarter): the earliest date at the lowest, discrete median and highest price.

    entity, quarter, n_days, kind, date, entry.  One aggregation: a quarter's
    prints, some sixty at most, are sorted as an array.
    """
    days = F.array_sort(F.collect_list(F.struct("close", "date")))
    g = prices.where("close is not null").groupBy("entity", F.trunc("date", "quarter").alias("quarter")).agg(days.alias("days"))
    n = F.size("days")
    at = lambda c: F.filter("days", lambda x: x["close"] == c)[0]
    picks = {"median": F.get("days", F.floor((n + 1) / 2).cast("int") - 1)["close"], "low": F.get("days", F.lit(0))["close"], "high": F.get("days", n - 1)["close"]}
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), at(c)["date"].alias("date"), c.alias("entry")) for k, c in picks.items()])
    return g.select("entity", "quarter", n.cast("long").alias("n_days"), F.inline(rows))


def resolve_as_of(calendar: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row, as_of and end_ix: the last trading day at or before ``as_of`` (the calendar's end, if none is given)."""
    c = calendar if as_of is None else calendar.where(F.col("date") <= F.lit(as_of).cast("date"))
    return c.agg(F.max("date").alias("as_of"), F.max("ix").alias("end_ix"))


def latest_snapshots(prices: DataFrame, calendar: DataFrame, max_age: int = 5, as_of: str | None = None) -> DataFrame:
    """The last print of each entity at ``as_of``, kept if at most ``max_age`` trading days old then; all in the quarter of that day."""
    end = resolve_as_of(calendar, as_of)
    p = prices if as_of is None else prices.where(F.col("date") <= F.lit(as_of).cast("date"))
    last = p.groupBy("entity").agg(F.max("date").alias("date"), F.max_by("close", "date").alias("entry"))
    age = F.col("end_ix") - F.col("ix")
    return last.join(F.broadcast(calendar), "date").crossJoin(F.broadcast(end)).where(age <= max_age).select("entity", F.trunc("as_of", "quarter").alias("quarter"), F.lit("inference").alias("kind"), "date", "entry", age.alias("age"))


def snapshot_summary(snaps: DataFrame) -> DataFrame:
    """kind, n, n_entities, first and last date, share of snapshots on the last day of three or more prints."""
    return snaps.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("entity").alias("n_entities"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.median("n_days").alias("median_days"))


def horizon_ends(dates: DataFrame, calendar: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """date, h, end_date, end_ix for each observable (date, horizon): the last trading day at or before date + h years."""
    if any(h < 1 for h in horizons):
        raise ValueError("horizons are whole years, 1 at least")
    end = calendar.agg(F.max("date").alias("__max"))
    nominal = dates.select("date").distinct().withColumn("h", F.explode(F.array(*map(F.lit, horizons)))).withColumn("target", add_years(F.col("date"), F.col("h")))
    seen = nominal.crossJoin(F.broadcast(end)).where("target <= __max").drop("__max").withColumn("one", F.lit(1))
    hit = asof_join(seen, calendar.select(F.col("date").alias("end_date"), F.col("ix").alias("end_ix")).withColumn("one", F.lit(1)), ["one"], "target", "end_date", ["end_ix"], how="inner")
    return hit.select("date", "h", "end_date", "end_ix")


def terminal_windows(ends: DataFrame, calendar: DataFrame, window: int = 21) -> DataFrame:
    """date, h, pos, day: the ``window`` trading days that end at each horizon end."""
    days = ends.withColumn("ix", F.explode(F.sequence(F.greatest(F.col("end_ix") - (window - 1), F.lit(1)), F.col("end_ix"))))
    return days.join(F.broadcast(calendar.withColumnRenamed("date", "day")), "ix").select("date", "h", (F.col("ix") - F.col("end_ix") + window - 1).alias("pos"), "day")


SPAN = "h int, end_date date, avg_end double, min_end double, max_end double, last_end double, max_drawdown double, fall_from_entry double"


def span_stats(prices: DataFrame, calendar: DataFrame, asks: DataFrame, window: int = 21) -> DataFrame:
    """``asks`` (entity, date, entry, ends and others) with ``spans`` in place of ``ends``: what prices did from its date to each of them.

    ``ends`` is an array of (h, end_date, end_ix).  A span has h, end_date; the
    average, lowest, highest and last price over the ``window`` trading days
    that end there, the last print carried on (days before the first print
    don't count); the largest fall from a running peak and the fall from the
    entry to the lowest price.  Null where no print says, or no entity.  Prints
    and asks are dealt out once by entity; a task reads its entities in turn
    and holds those of one batch.
    """
    at = F.broadcast(calendar.select("date", F.col("ix").cast("long").alias("__ix")))
    placed = asks.join(at, "date").select(*asks.columns, "__ix", F.lit(True).alias("__ask"))
    prints = prices.where("close is not null").join(at, "date").select("entity", "__ix", F.col("close").alias("__close"))
    rows = placed.unionByName(prints, allowMissingColumns=True).repartition("entity").sortWithinPartitions("entity")
    keys, names = [c for c in asks.columns if c != "ends"], [x.split()[0] for x in SPAN.split(", ")]
    kinds = {f.name: f.dataType.simpleString() for f in asks.schema.fields}
    out = ", ".join(f"{c} {kinds[c]}" for c in keys) + f", spans array<struct<{', '.join(x.replace(' ', ': ') for x in SPAN.split(', '))}>>"
    read = _span_reader(window)

    def of_entities(table):
        import numpy as np
        import pyarrow as pa

        entity = table.column("entity").to_numpy()
        group = np.concatenate([[0], np.cumsum(entity[1:] != entity[:-1])]).astype("int64")
        is_ask = table.column("__ask").fill_null(False).to_numpy()
        asked = table.filter(pa.array(is_ask)).combine_chunks()
        lists = asked.column("ends").combine_chunks()
        ends, sizes = lists.flatten(), np.asarray(lists.value_lengths().fill_null(0))
        ix, close = table.column("__ix").to_numpy(), table.column("__close").to_numpy()
        each = lambda v: np.repeat(v, sizes)
        values = read(group[~is_ask], ix[~is_ask], close[~is_ask], each(group[is_ask]), each(ix[is_ask]), each(asked.column("entry").to_numpy()), ends.field("end_ix").to_numpy(zero_copy_only=False))
        fields = [pa.array(v, mask=np.isnan(v)) for v in values]
        spans = pa.StructArray.from_arrays([ends.field("h").cast("int32"), ends.field("end_date"), *fields], names=names)
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32")), spans)
        return asked.select(keys).append_column("spans", spans).to_batches()

    def stats(batches):
        import numpy as np
        import pyarrow as pa

        held = []  # rows of the entity that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            entity = pa.Table.from_batches([*held[-1:], batch]).column("entity").to_numpy()
            before = len(entity) - batch.num_rows
            new = np.flatnonzero(entity[1:] != entity[:-1]) + 1 - before
            new = int(new[-1]) if len(new) and new[-1] >= 0 else None  # where the batch's last entity begins
            if new is not None:
                done = pa.Table.from_batches([*held, batch.slice(0, new)])
                if done.num_rows:
                    yield from of_entities(done)
                held = []
            held.append(batch.slice(new or 0))
        if held:
            yield from of_entities(pa.Table.from_batches(held))

    return rows.mapInArrow(stats, out)


def _span_reader(window: int):
    """A function of prints (group, ix, close) and spans (group, at, entry, end), groups ascending in both.

    It gives avg_end, min_end, max_end, last_end, max_drawdown, fall_from_entry
    of each span over its group's prints, NaN where there is none, and travels
    to the tasks whole.
    """

    def read(print_group, print_ix, close, group, at, entry, end) -> list:
        import numpy as np

        none = np.full(len(at), np.nan)
        if not len(print_ix) or not len(at):
            return [none] * 6
        key = lambda g, ix: g * 2**33 + ix
        places = key(print_group, print_ix)
        order = np.argsort(places, kind="stable")
        places, close = places[order], close[order]
        owner = places >> 33
        last = np.searchsorted(places, key(group, end), "right") - 1
        known = (last >= 0) & (owner[last] == group)
        days = end[:, None] - np.arange(window - 1, -1, -1)
        place = np.searchsorted(places, key(group[:, None], days), "right") - 1  # the last print at or before each day
        inside = (days >= 1) & (place >= 0) & (owner[place] == group[:, None])
        carried = close[place]
        with np.errstate(divide="ignore", invalid="ignore"):
            avg = np.cumsum(np.where(inside, carried, 0.0), axis=1)[:, -1] / inside.sum(axis=1)  # day by day, as any engine adds
            low, high = np.where(inside, carried, np.inf).min(axis=1), np.where(inside, carried, -np.inf).max(axis=1)
            fall, bottom = none.copy(), none.copy()
            first = np.searchsorted(places, key(group, at), "left")
            ok = known & (last >= first)
            ok[ok] = places[first[ok]] == key(group, at)[ok]
            by_start = np.flatnonzero(ok)
            by_start = by_start[np.argsort(first[by_start], kind="stable")]
            cuts = [*(np.flatnonzero(np.diff(first[by_start], prepend=-1))), len(by_start)]
            for lo, hi in zip(cuts, cuts[1:]):
                mine = by_start[lo:hi]
                start, to = first[mine[0]], last[mine]
                path = close[start : to.max() + 1]
                drops = np.maximum.accumulate(1 - path / np.maximum.accumulate(path))
                fall[mine], bottom[mine] = drops[to - start], np.minimum.accumulate(path)[to - start]
            mask = lambda v: np.where(known, v, np.nan)
            return [mask(avg), mask(low), mask(high), mask(close[last]), np.maximum(fall, 0.0), np.maximum(1 - bottom / entry, 0.0)]

    return read


def span_rows(spans: DataFrame) -> DataFrame:
    """``span_stats`` as a row for each span that has a print, with its h, end_date and values."""
    return spans.select(*[c for c in spans.columns if c != "spans"], F.inline("spans")).where("last_end is not null")


def growth(end, entry, h):
    return F.pow(end / entry, F.lit(1.0) / h) - 1


GROWTH = {"cagr": "avg_end", "p2p": "last_end", "cagr_min": "min_end", "cagr_max": "max_end"}


def _growths(x, bench_end, bench_entry, h) -> dict[str, Column]:
    """CAGRs of the terminal prices and of the benchmark, and the loss; ``x`` gives the column of entry, avg_end and so on."""
    out = {name: growth(x(end), x("entry"), h) for name, end in GROWTH.items()}
    return out | {"bench_cagr": growth(bench_end, bench_entry, h), "loss": F.greatest(F.lit(0.0), 1 - x("min_end") / x("entry"))}


def _ties(x, tie) -> dict[str, Column]:
    """excess over the benchmark, and the two growths as they meet thresholds."""
    excess = x("cagr") - x("bench_cagr")
    return {"excess": excess, "__cagr": tie(x("cagr")), "__excess": tie(excess)}


def _flags(x, cagr_pct: tuple[int, ...], excess_pct: tuple[int, ...]) -> dict[str, Column]:
    """Threshold flags: reached at the threshold; beat only above it."""
    return {f"cagr_ge_{p}": x("__cagr") >= p / 100 for p in cagr_pct} | {f"excess_ge_{p}": x("__excess") >= p / 100 for p in excess_pct} | {"beat": x("__excess") > 0}


def label_long(stats: DataFrame, bench_stats: DataFrame, cagr_pct: tuple[int, ...] = CAGR_PCT, excess_pct: tuple[int, ...] = EXCESS_PCT, tie=lambda c: c) -> DataFrame:
    """CAGRs of the terminal prices (``span_rows``), excess over the benchmark, loss and threshold flags.

    ``tie`` is applied to growth before it meets a threshold.
    """
    j = stats.join(F.broadcast(bench_stats), ["date", "h"], "left")
    out = j.withColumns(_growths(F.col, F.col("bench_end"), F.col("bench_entry"), F.col("h")))
    return out.withColumns(_ties(F.col, tie)).withColumns(_flags(F.col, cagr_pct, excess_pct)).drop("__cagr", "__excess")


def label_wide(spans: DataFrame, bench_stats: DataFrame, reasons: DataFrame, cols: tuple[str, ...], horizons: tuple[int, ...] = HORIZONS, tie=lambda c: c) -> DataFrame:
    """The rows of ``spans`` (as ``span_stats``) with a column for each of ``cols`` and horizon; all null where a horizon has no span.

    ``cols`` are a span's, those of ``label_long`` and ``ended``: the reason
    (from ``reasons``: entity, last_date, reason) where the entity's last print
    lies before the span's end, else 'false'.  Rows stay where they lie.
    """
    at = bench_stats.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("h", F.struct("bench_end", "bench_entry")))).alias("__bench"))
    keys = [c for c in spans.columns if c != "spans"]
    span = lambda h: F.get(F.filter("spans", lambda x: (x["h"] == h) & x["last_end"].isNotNull()), F.lit(0))
    j = spans.select(*keys, *[span(h).alias(f"__{h}") for h in horizons]).join(F.broadcast(at), "date", "left").join(reasons.select("entity", "last_date", "reason"), "entity", "left")
    own = [x.split()[0] for x in SPAN.split(", ")]
    x = lambda h: lambda c: F.col(c) if c in keys else F.col(f"__{h}")[c] if c in own else F.col(f"__{c}_{h}")
    named = lambda h, made: {f"__{n}_{h}": c for n, c in made.items()}
    # one step builds on the other, so that nothing is made twice
    for step in (lambda h: _growths(x(h), F.col("__bench")[h]["bench_end"], F.col("__bench")[h]["bench_entry"], F.lit(h)), lambda h: _ties(x(h), tie), lambda h: _flags(x(h), CAGR_PCT, EXCESS_PCT)):
        j = j.withColumns({k: c for h in horizons for k, c in named(h, step(h)).items()})
    # the benchmark says nothing about a horizon that a row doesn't have
    there = lambda h, c: F.when(F.col(f"__{h}").isNotNull(), c)
    ended = lambda h: F.when(F.col("last_date") < F.col(f"__{h}")["end_date"], F.col("reason")).otherwise("false")
    return j.select(*keys, *[(x(h)(c) if c in own else there(h, ended(h) if c == "ended" else x(h)(c))).alias(f"{c}_{h}y") for h in horizons for c in cols])


def bench_stats(windows: DataFrame, bench: DataFrame) -> DataFrame:
    """date, h, bench_end (average over the window) and bench_entry, each by the last benchmark price at or before the day."""
    b = bench.select(F.col("date").alias("b_date"), "bench").withColumn("one", F.lit(1))
    days = asof_join(windows.select("day").distinct().withColumn("one", F.lit(1)), b, ["one"], "day", "b_date", ["bench"]).select("day", "bench")
    ends = windows.join(F.broadcast(days), "day").groupBy("date", "h").agg(F.avg("bench").alias("bench_end"))
    entry = asof_join(windows.select("date").distinct().withColumn("one", F.lit(1)), b, ["one"], "date", "b_date", ["bench"]).select("date", F.col("bench").alias("bench_entry"))
    return ends.join(F.broadcast(entry), "date")


def delisted_in_window(long: DataFrame, ends: DataFrame) -> DataFrame:
    """Labels with ``ended``: the reason where the entity's last print lies before the horizon's end, else 'false'."""
    j = long.join(ends.select("entity", "last_date", "reason"), "entity", "left")
    return j.withColumn("ended", F.when(F.col("last_date") < F.col("end_date"), F.col("reason")).otherwise("false")).drop("last_date", "reason")


def max_drawdown(prices: DataFrame, spans: DataFrame) -> DataFrame:
    """Largest fall from a running peak over each span (entity, kind, date, entry, h, end_date), the entry being the first peak; spans that begin at no print give nothing."""
    day = lambda c: F.datediff(c, F.lit("1900-01-01").cast("date")).cast("long")
    dates = prices.select("date").unionByName(spans.select("date")).distinct().select("date", day("date").alias("ix"))
    one = spans.select("entity", "kind", "date", "entry", F.array(F.struct("h", "end_date", day("end_date").alias("end_ix"))).alias("ends"))
    rows = span_rows(span_stats(prices, dates, one)).where("max_drawdown is not null")
    return rows.select("entity", "kind", "date", "entry", "h", "max_drawdown", "fall_from_entry")
