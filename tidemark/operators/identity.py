"""Entity resolution: deduplication, key reuse, universe flags, ends of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.asof import latest_by

# Reasons for an end, the strongest first.
END_REASONS = ["bankruptcyliquidation", "regulatorydelisting", "voluntarydelisting", "acquisitionby", "mergerfrom", "delisted"]


def dedup_latest(df: DataFrame, key: str, updated: str, tie: str) -> DataFrame:
    """One row per non-null key: the newest, nulls last, then the smallest ``tie``."""
    return latest_by(df.where(F.col(key).isNotNull()), [key], F.col(updated).desc_nulls_last(), F.col(tie).asc())


def flag_reuse(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("is_reused", F.count("*").over(Window.partitionBy(key)) > 1)


def universe_flags(df: DataFrame, category: str, code: str, sector: str, categories: list[str], code_range: tuple[int, int] = (6000, 6499), excluded_sector: str | None = None) -> DataFrame:
    """Flags instead of dropped rows: a missing code keeps the row and is marked."""
    out = df.withColumn("is_category", F.coalesce(F.col(category).isin(categories), F.lit(False)))
    out = out.withColumn("is_financial", F.coalesce(F.col(code).between(*code_range), F.lit(False))).withColumn("code_missing", F.col(code).isNull())
    out = out.withColumn("sector_disagrees", F.coalesce((F.col(sector) == excluded_sector) != F.col("is_financial"), F.lit(False)))
    return out.withColumn("in_universe", F.col("is_category") & ~F.col("is_financial"))


def universe_summary(flags: DataFrame) -> DataFrame:
    return flags.agg(F.count("*").alias("n_rows"), F.count_if("is_category").alias("n_category"), F.count_if("is_financial").alias("n_financial"), F.count_if("code_missing").alias("n_code_missing"), F.count_if("in_universe").alias("n_universe"))


def active_by_year(df: DataFrame, first: str, last: str, start_year: int, today) -> DataFrame:
    """year, n_active, n_ended: entities whose life touches each year; an open end reaches to ``today``.

    Rows without a first date are left out; the years are exploded per entity,
    which needs no range join.
    """
    to = F.coalesce(F.col(last), today)
    lo = F.greatest(F.year(first), F.lit(start_year))
    rows = df.where(F.col(first).isNotNull()).withColumn("__to", F.year(to)).withColumn("__lo", lo).where("__lo <= __to")
    return rows.withColumn("year", F.explode(F.sequence("__lo", "__to"))).groupBy("year").agg(F.count("*").alias("n_active"), F.count_if(F.col(last).isNotNull()).alias("n_ended"))


def unplaceable(df: DataFrame, first: str, last: str) -> DataFrame:
    """How many entities can't be placed in time: n_rows, n_unplaceable (no first date), n_only_end (but a last one)."""
    lost = F.col(first).isNull()
    return df.agg(F.count("*").alias("n_rows"), F.count_if(lost).alias("n_unplaceable"), F.count_if(lost & F.col(last).isNotNull()).alias("n_only_end"))


def in_universe(prices: DataFrame, flags: DataFrame, price: str) -> DataFrame:
    """Prices above 0 (null ones go) of the entities flagged ``in_universe``."""
    return prices.where(F.col(price) > 0).join(flags.where("in_universe").select("entity"), "entity", "left_semi")


def end_reasons(entities: DataFrame, actions: DataFrame, last_prices: DataFrame, grace_days: int = 30) -> DataFrame:
    """entity, last_date, last_close, reason of ended entities; the strongest reason near the end, else 'unknown'."""
    ended = entities.where("delisted").select("entity", "ticker").join(last_prices, "entity")
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, END_REASONS)), F.col("action")), F.lit(0))
    a = actions.where(F.col("action").isin(END_REASONS)).withColumn("__rank", rank)
    near = ended.join(a, "ticker").where(F.col("date").between(F.date_sub("last_date", grace_days), F.date_add("last_date", grace_days)))
    best = latest_by(near, ["entity"], F.col("__rank").asc(), F.col("date").asc()).select("entity", F.col("action").alias("reason"))
    return ended.join(best, "entity", "left").select("entity", "last_date", "last_close", F.coalesce("reason", F.lit("unknown")).alias("reason"))


def last_prints(prices: DataFrame) -> DataFrame:
    return prices.groupBy("entity").agg(F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close"))
