"""Cross-sections: ranks, group medians, composites, tie audit, uniqueness weights, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import add_years, md5_bucket
from tidemark.operators.cross_sections import array_of, rank_counts, ranked_rows

FAR = "9999-12-31"
PART = 24  # columns from which on tests call them many


def cross_rank(df: DataFrame, key: list[str], specs: dict[str, tuple[float, float] | None], partition: list[str], guard: int = 20, dealt: bool = False, values: bool = False, deal: list[str] | None = None) -> DataFrame:
    """``key`` and a rank column ``{name}_rank`` in [0, 1] for each of ``specs``, after the value itself with ``values``.

    Rows are dealt out by ``partition`` (or the part of it that ``deal`` names)
    once, all columns as one array, or not at all if they are ``dealt`` out so
    already; any number of columns costs this one shuffle.  A task sorts its
    rows by group and ranks one column of a group after the other
    (``cross_sections``).  None ranks in full; (pin, at) puts the value ``pin``
    at rank ``at``, smaller values below it and larger ones above.  Groups with
    fewer than ``guard`` values have no rank; ties share the lower one; nulls
    have none.
    """
    ids = list(dict.fromkeys([*key, *partition]))
    rows = df.select(*ids, array_of(list(specs)).alias("__values"))
    rows = rows if dealt else rows.repartition(*(deal or partition))
    return ranked_rows(rows, "__values", key, partition, specs, guard, values)


def group_medians(df: DataFrame, by: list[str], cols: list[str], least: int = 5) -> DataFrame:
    """Medians by group, null where fewer than ``least`` values stand."""
    return df.groupBy(*by).agg(*[F.when(F.count(c) >= least, F.median(c)).alias(f"med_{c}") for c in cols])


def growth_score(df: DataFrame, medians: DataFrame, by: list[str], cols: list[str], own: Column) -> DataFrame:
    """Comparisons with the group's medians plus one of the firm's own, summed; null where any is."""
    j = df.join(medians, by, "left")
    return j.withColumn("g_score", reduce(lambda a, c: a + (F.col(c) > F.col(f"med_{c}")).cast("int"), cols, own.cast("int")))


def tie_audit(df: DataFrame, rank_cols: list[str], partition: str, group: str) -> DataFrame:
    """How far tied rank values give their partition away, per (column, group).

    n_rows, n_partitions, n_values, n_pairs, tie_mass (share of rows that share
    their value within the partition), keyed_mass (the share whose tied value
    stands in one partition only), max_key_share with the partition and value
    it stands at.
    """
    rows = _tie_rows(df, partition, group, [F.struct(F.col(c).cast("double").alias("value")) for c in rank_cols])
    values = _tied_values(rows, [])
    sizes = rows.groupBy("i", "g", "p").agg(F.count("*").alias("size"))
    out = _with_sizes(values, sizes).groupBy("i", "g").agg(*_tie_measures())
    n = sizes.groupBy(F.col("i").alias("__i"), F.col("g").alias("__g")).agg(F.count_distinct("p").alias("n_partitions"))
    out = out.join(F.broadcast(n), (F.col("i") == F.col("__i")) & F.col("g").eqNullSafe(F.col("__g")))
    return _audited(out, rank_cols, group)


def _tie_measures() -> list[Column]:
    """What ``tie_audit`` says of a column and group, from its values with n, spread, tied, p and size."""
    keyed = (F.col("n") > 1) & (F.col("spread") == 1)
    share = F.when(keyed, F.col("n") / F.col("size"))
    total = F.sum("n").cast("double")
    return [
        F.sum("n").alias("n_rows"), F.count("*").alias("n_values"), F.sum("spread").alias("n_pairs"),
        F.try_divide(F.sum("tied").cast("double"), total).alias("tie_mass"), F.try_divide(F.sum(F.when(keyed, F.col("n")).otherwise(0)).cast("double"), total).alias("keyed_mass"),
        F.max(share).alias("max_key_share"), F.max(F.when(keyed, F.struct(share.alias("s"), F.col("p"), F.col("value")))).alias("at"),
    ]


def _audited(out: DataFrame, names: list[str], group: str) -> DataFrame:
    return out.select(_name(names), F.col("g").alias(group), "n_rows", "n_partitions", "n_values", "n_pairs", "tie_mass", "keyed_mass", "max_key_share", F.col("at.p").alias("at_partition"), F.col("at.value").alias("at_value"))


def rank_audit(df: DataFrame, specs: dict[str, tuple[float, float] | None], partition: str, group: str, guard: int = 20) -> DataFrame:
    """``tie_audit`` of the ranks that ``cross_rank`` gives within (partition, group), rounded to 6 places.

    No row is put together again: a task that ranks a column of a group says
    how many rows have each rank, and only these counts go on.
    """
    values = _ranked_values(df, specs, partition, group, guard)
    out = values.groupBy("i", "g").agg(*_tie_measures(), F.sum("first").alias("n_partitions"))
    return _audited(out, [f"{c}_rank" for c in specs], group)


def rank_audit_detail(df: DataFrame, specs: dict[str, tuple[float, float] | None], partition: str, group: str, most: float = 0.02, k: int = 1, guard: int = 20) -> DataFrame:
    """``audit_detail`` of the ranks that ``cross_rank`` gives within (partition, group), rounded to 6 places, from the counts of ``rank_audit``."""
    keyed = _ranked_values(df, specs, partition, group, guard).where("n > 1 and spread = 1").withColumn("share", F.col("n") / F.col("size"))
    return _worst_ties(keyed, [f"{c}_rank" for c in specs], group, most, k)


def _ranked_values(df: DataFrame, specs: dict[str, tuple[float, float] | None], partition: str, group: str, guard: int) -> DataFrame:
    """As ``_tied_values``, with size (of the partition p), raw (the smallest value) and first (in how many partitions, null aside, it stands first)."""
    # dealt out by the partition, where rows of one entity lie side by side and pack well
    rows = df.select(partition, group, array_of(list(specs)).alias("__values")).repartition(partition)
    pairs = rank_counts(rows, "__values", [partition, group], specs, guard).withColumnsRenamed({partition: "p", group: "g"})
    return pairs.groupBy("i", "g", "value").agg(F.sum("n").alias("n"), F.count("*").alias("spread"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("tied"), F.max("p").alias("p"), F.max("size").alias("size"), F.min("raw").alias("raw"), F.sum(F.when(F.col("p").isNotNull(), F.col("first")).otherwise(0)).alias("first"))


def _tie_rows(df: DataFrame, partition: str, group: str, entries: list[Column]) -> DataFrame:
    """p, g, i (the column's number) and the fields of its entry, for each value that isn't null."""
    return df.select(F.col(partition).alias("p"), F.col(group).alias("g"), F.posexplode(F.array(*entries)).alias("i", "__e")).select("p", "g", "i", "__e.*").where("value is not null")


def _tied_values(rows: DataFrame, least: list[str]) -> DataFrame:
    """(i, g, value): n rows in ``spread`` partitions, ``tied`` of them where the partition has more than one, the partition p (if there is one only), smallest ``least``."""
    pairs = rows.groupBy("i", "g", "p", "value").agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in least])
    return pairs.groupBy("i", "g", "value").agg(F.sum("n").alias("n"), F.count("*").alias("spread"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("tied"), F.max("p").alias("p"), *[F.min(c).alias(c) for c in least])


def _with_sizes(values: DataFrame, sizes: DataFrame) -> DataFrame:
    """``values`` with the rows of (i, g, p), of which there are few: they are broadcast."""
    z = sizes.select(F.col("i").alias("__i"), F.col("g").alias("__g"), F.col("p").alias("__p"), "size")
    return values.join(F.broadcast(z), (F.col("i") == F.col("__i")) & F.col("g").eqNullSafe(F.col("__g")) & F.col("p").eqNullSafe(F.col("__p")), "left").drop("__i", "__g", "__p")


def _name(names: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("column")


def audit_summary(audit: DataFrame, most: float = 0.02) -> DataFrame:
    """column, tie_mass, keyed_mass and max_key_share of the worst group, and whether that is above ``most``."""
    g = audit.groupBy("column").agg(*[F.max(c).alias(c) for c in ("tie_mass", "keyed_mass", "max_key_share")])
    return g.withColumn("flagged", F.coalesce(F.col("max_key_share") > most, F.lit(False)))


def audit_detail(df: DataFrame, raw: dict[str, str], partition: str, group: str, most: float = 0.02, k: int = 1) -> DataFrame:
    """Of every flagged (rank column, group) the ``k`` ties that give most away: column, group, place, share, key_partition, key_rank, key_raw.

    A tie is keyed if its value stands in one partition of the group only;
    ``share`` is its rows over the partition's.  A column and group is flagged
    if its largest share is above ``most``.  Worst first: by share, then later
    partition, then larger value.  ``raw`` names the feature behind each rank
    column; key_raw is its smallest value in the tie.  The best of each task
    are picked before they are shuffled, so no task sorts all ties of a column.
    """
    rows = _tie_rows(df, partition, group, [F.struct(F.col(c).cast("double").alias("value"), F.col(x).cast("double").alias("raw")) for c, x in raw.items()])
    keyed = _tied_values(rows, ["raw"]).where("n > 1 and spread = 1")
    sized = _with_sizes(keyed, rows.groupBy("i", "g", "p").agg(F.count("*").alias("size"))).withColumn("share", F.col("n") / F.col("size"))
    return _worst_ties(sized, list(raw), group, most, k)


def _worst_ties(ties: DataFrame, names: list[str], group: str, most: float, k: int) -> DataFrame:
    order = Window.partitionBy("i", "g").orderBy(F.desc("share"), F.desc("p"), F.desc("value"))
    best = ties.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    worst = F.max("share").over(Window.partitionBy("i", "g"))
    return best.withColumn("__worst", worst).where(F.col("__worst") > most).select(_name(names), F.col("g").alias(group), "place", "share", F.col("p").alias("key_partition"), F.col("value").alias("key_rank"), F.col("raw").alias("key_raw"))


def audit_gate(audit: DataFrame, most: float = 0.02) -> DataFrame:
    """The worst group of each column and whether it is above ``most``."""
    return audit.groupBy("column").agg(F.max("max_key_share").alias("worst")).withColumn("flagged", F.coalesce(F.col("worst") > most, F.lit(False)))


def uniqueness_weights(windows: DataFrame, by: str | list[str], start: str, end: str, key: list[str]) -> DataFrame:
    """Average of 1 / (windows open on the day) over the days of each window, both ends included.

    Boundaries change the count by one; between them it is constant, so the
    integral of 1 / count is a running sum over boundaries and a window's
    weight is a difference of two of its values.  ``key`` names a window once
    and has ``by``.  Windows are dealt out by ``by`` once, if they don't lie so
    already, and met by nothing: each is two rows of the running sum.  Without
    a start or an end, or if that lies before it, a window has no weight.
    """
    by = [by] if isinstance(by, str) else by
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    edge = lambda c, x: F.struct(c.alias("__d"), F.lit(x).alias("__x"))
    open_ = edge(day(F.col(start)), 1), edge(day(F.col(end)) + 1, -1)
    none = edge(F.lit(None).cast("int"), 0)
    held = list(dict.fromkeys([*by, *key]))
    rows = windows.select(*held, F.inline(F.when(F.col(start) <= F.col(end), F.array(*open_)).otherwise(F.array(none))))
    run = Window.partitionBy(*by).orderBy("__d")
    rows = rows.withColumn("__open", F.sum("__x").over(run.rangeBetween(Window.unboundedPreceding, 0))).withColumn("__len", F.lead("__d").over(run) - F.col("__d"))
    # of several boundaries on a day all but the last are followed by none of its days
    piece = F.when(F.col("__open") > 0, F.col("__len") / F.col("__open")).otherwise(0.0)
    rows = rows.withColumn("__before", F.coalesce(F.sum(piece).over(run.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    at = lambda x, c: F.max(F.when(F.col("__x") == x, F.col(c)))
    weight = (at(-1, "__before") - at(1, "__before")) / (at(-1, "__d") - at(1, "__d"))
    return rows.groupBy(*held).agg(weight.alias("weight")).select(*key, "weight")


def fold_calendar(obs: DataFrame, holdout_years: int = 1, min_train_years: int = 2, embargo_days: int = 30) -> DataFrame:
    """scheme, fold, h, test_start, test_end, embargo_days for obs (h, date, observable).

    The holdout begins ``holdout_years - 1`` years before the last observable
    year and has no end; walk-forward folds are the years before it that leave
    ``min_train_years`` plus the horizon for training.
    """
    span = obs.where("observable").groupBy("h").agg(F.year(F.min("date")).alias("y0"), F.year(F.max("date")).alias("y1"))
    cut = F.col("y1") - (holdout_years - 1)
    hold = span.select(F.lit("holdout").alias("scheme"), cut.cast("int").alias("fold"), "h", F.make_date(cut, F.lit(1), F.lit(1)).alias("test_start"), F.lit(FAR).cast("date").alias("test_end"))
    first = F.col("y0") + min_train_years + F.col("h")
    walk = span.withColumn("lo", first).withColumn("hi", cut - 1).where("lo <= hi").withColumn("fold", F.explode(F.sequence("lo", "hi")))
    walk = walk.select(F.lit("walkforward").alias("scheme"), F.col("fold").cast("int").alias("fold"), "h", F.make_date("fold", F.lit(1), F.lit(1)).alias("test_start"), F.make_date(F.col("fold") + 1, F.lit(1), F.lit(1)).alias("test_end"))
    return hold.unionByName(walk).withColumn("embargo_days", F.lit(embargo_days))


def tag_roles(obs: DataFrame, folds: DataFrame, test_kind: str = "median") -> DataFrame:
    """Role of each observable row in each fold of its horizon; rows without a role are left out.

    train: the label ends, with the embargo, before the test starts; embargoed:
    it ends before the test but within the embargo; purged: it starts before
    the test and ends in or after it; test: it starts within the test.
    """
    j = obs.where("observable").join(F.broadcast(folds), "h")
    end = add_years(F.col("date"), F.col("h"))
    role = F.when(F.col("date") < F.col("test_start"), F.when(F.date_add(end, F.col("embargo_days")) < F.col("test_start"), "train").when(end < F.col("test_start"), "embargoed").otherwise("purged"))
    role = role.when((F.col("date") < F.col("test_end")) & (F.col("kind") == test_kind), "test")
    return j.withColumn("role", role).where("role is not null")


def fold_manifest(folds: DataFrame, tags: DataFrame) -> DataFrame:
    counts = tags.groupBy("scheme", "fold", "h").agg(*[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("train", "test", "purged", "embargoed")])
    j = folds.join(counts, ["scheme", "fold", "h"], "left")
    return j.select(*folds.columns, *[F.coalesce(f"n_{r}", F.lit(0)).alias(f"n_{r}") for r in ("train", "test", "purged", "embargoed")])


def diagnostic_folds(horizons: tuple[int, ...], like: DataFrame, folds: int = 5) -> DataFrame:
    """Fold rows of the hash schemes, which have no test dates: entity_holdout (fold 0) and random_kfold (0 to folds - 1) for each horizon."""
    rows = F.array(*[F.struct(F.lit(s).alias("scheme"), F.lit(k).alias("fold"), F.lit(h).alias("h")) for h in horizons for s, n in (("entity_holdout", 1), ("random_kfold", folds)) for k in range(n)])
    none = F.lit(None).cast("date")
    return like.sparkSession.range(1).select(F.inline(rows)).select("*", none.alias("test_start"), none.alias("test_end"), F.lit(0).alias("embargo_days"))


def write_splits(tags: list[DataFrame], path: str, key: list[str], mode: str = "errorifexists") -> None:
    """All tags (scheme, fold, h, key..., role) as one table, in folders by scheme and horizon, sorted inside."""
    cols = ["scheme", "fold", "h", *key, "role"]
    every = reduce(DataFrame.unionByName, [t.select(*cols) for t in tags])
    every.repartition("scheme", "h", key[0]).sortWithinPartitions("scheme", "h", "fold", *key).write.mode(mode).partitionBy("scheme", "h").parquet(path)


def role_summary(tags: DataFrame) -> DataFrame:
    return tags.groupBy("scheme", "h", "role").agg(F.count("*").alias("n"), F.count_distinct("fold").alias("n_folds"))


def hash_split(obs: DataFrame, cols: list[str], before: Column, buckets: int = 5) -> DataFrame:
    """Bucket 0 of an md5 of ``cols`` is the test, the others train; rows not ``before`` are left out."""
    return obs.where(before).withColumn("role", F.when(md5_bucket(buckets, *[F.col(c) for c in cols]) == 0, "test").otherwise("train"))


def random_folds(obs: DataFrame, cols: list[str], before: Column, folds: int = 5) -> DataFrame:
    """Every row once in each fold: test where its bucket is the fold's number."""
    rows = obs.where(before).withColumn("bucket", md5_bucket(folds, *[F.col(c) for c in cols])).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    return rows.withColumn("role", F.when(F.col("bucket") == F.col("fold"), "test").otherwise("train"))


def select_role(panel: DataFrame, tags: DataFrame, key: list[str], scheme: str, fold: int, h: int, role: str = "train") -> DataFrame:
    """Panel rows with a role in one fold."""
    return panel.join(tags.where((F.col("scheme") == scheme) & (F.col("fold") == fold) & (F.col("h") == h) & (F.col("role") == role)).select(*key), key, "left_semi")
