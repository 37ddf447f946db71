"""The panel relations read from star-schema tables, whole tables each time.

Suppliers are the entities; suppliers whose key ends in 8 and 9 share a ticker
with disjoint windows.  Prices are money over quantity of a day's lines, in
whole cents, so that sums don't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import validity_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listing(k: Column) -> list[Column]:
    """entity, ticker and its validity window of supplier ``k``."""
    return [
        k.alias("entity"),
        F.concat(F.lit("T"), (k - F.when(k % 10 == 9, 1).otherwise(0)).cast("string")).alias("ticker"),
        F.when(k % 10 == 9, F.lit("1998-07-01").cast("date")).alias("first_date"),
        F.when(k % 10 == 8, F.lit("1998-06-30").cast("date")).alias("last_date"),
    ]


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, ticker, first_date, last_date, sector, industry, code, delisted: one row per supplier."""
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey")
    return s.select(
        *_listing(k),
        F.col("r_name").alias("sector"),
        F.col("n_name").alias("industry"),
        F.when(k % 13 != 0, 6000 + k * 37 % 900).cast("int").alias("code"),
        F.when(k % 11 == 0, "ADR").when(k % 7 == 0, "ETF").otherwise("Common").alias("category"),
        (k % 11 == 0).alias("delisted"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, date, cents, qty, back of every line, also of entities that aren't known."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_shipdate").cast("date").alias("date"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), F.col("l_quantity").cast("long").alias("qty"), (F.col("l_returnflag") == "R").cast("long").alias("back"))


def _known(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """``rows`` of known entities."""
    return rows.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity")), "entity", "left_semi")


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, ticker, first_date, last_date of ``entities``.  Nations only restrict suppliers here, so Spark knows how small this is and may broadcast it."""
    nations = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    s = table(spark, sf_dir, "supplier").join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return s.select(*_listing(F.col("s_suppkey")))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, date, close, volume: lines of a ticker resolved through the validity windows, then dealt out by entity once and added up by day."""
    names = _listings(spark, sf_dir)
    li = _lines(spark, sf_dir).select("entity", "date", "cents", "qty").join(names.select("entity", "ticker"), "entity").select("ticker", "date", "cents", "qty")
    li = validity_join(li, names, "ticker", "date", "first_date", "last_date", "entity").select("entity", "date", "cents", "qty").repartition("entity")
    return li.groupBy("entity", "date").agg((F.sum("cents").cast("double") / (100 * F.sum("qty").cast("double"))).alias("close"), F.sum("qty").cast("double").alias("volume"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, bench: the price over all entities."""
    return _known(spark, sf_dir, _lines(spark, sf_dir).select("entity", "date", "cents", "qty")).groupBy("date").agg((F.sum("cents").cast("double") / (100 * F.sum("qty").cast("double"))).alias("bench"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, datekey, reportperiod and amounts per ship quarter; each seventh quarter has a later amendment."""
    q = F.trunc("date", "quarter")
    g = _lines(spark, sf_dir).groupBy("entity", q.alias("q")).agg(F.sum("cents").alias("c"), F.sum("qty").alias("n"), F.sum("back").alias("b"), F.count("*").alias("k"))
    g = _known(spark, sf_dir, g)  # after the sums: only they are shuffled
    period = F.date_sub(F.add_months("q", 3), 1)
    number = (F.year("q") * 4 + F.quarter("q")).cast("long")
    base = g.select("entity", period.alias("reportperiod"), number.alias("number"), (F.col("c") / F.lit(100.0)).alias("rev"), F.col("n").cast("double").alias("qty"), F.col("b").cast("double").alias("back"), F.col("k").cast("double").alias("lines"))
    first = base.withColumn("datekey", F.date_add("reportperiod", 45)).withColumn("factor", F.lit(1.0))
    again = base.where("number % 7 = 0").withColumn("datekey", F.date_add("reportperiod", 115)).withColumn("factor", F.lit(1.25))
    x = first.unionByName(again)
    f = F.col("factor")
    return x.select(
        "entity", "datekey", "reportperiod", (F.col("rev") * f).alias("revenue"), (F.col("rev") * f * 0.5 - F.col("qty") * 100).alias("gp"), (F.col("rev") * 0.25 - F.col("qty") * F.col("back") * 50).alias("netinc"), (F.col("rev") * 0.125 - F.col("back") * 1000).alias("ncfo"),
        (F.col("rev") * 2 + F.col("qty")).alias("assets"), (F.col("rev") * 0.75 + F.col("back") * 500).alias("liabilities"), (F.col("rev") * 0.5).alias("assetsc"), (F.col("rev") * 0.25 + F.col("lines") * 100).alias("liabilitiesc"), (F.col("rev") * 0.125).alias("cash"), (F.col("rev") * 0.5).alias("debt"), (F.col("rev") * 0.25 - F.col("lines") * 200).alias("ebit"), (F.col("rev") * 0.5 - F.col("back") * 2000).alias("retearn"), (F.col("qty") * 10).alias("shares"), F.when(F.col("back") > 2, F.col("back") * 10).otherwise(0.0).alias("dividends"),
    )


def endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, date, action of delisted entities, up to 40 days after their last line."""
    e = entities(spark, sf_dir).where("delisted")
    last = _lines(spark, sf_dir).groupBy("entity").agg(F.max("date").alias("last"))
    kinds = F.array(*[F.lit(x) for x in ("delisted", "mergerfrom", "bankruptcyliquidation", "acquisitionby", "regulatorydelisting", "voluntarydelisting")])
    at = e.join(last, "entity").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    return at.select("ticker", F.date_add("last", F.expr("cast(entity % 41 as int) * n")).alias("date"), F.element_at(kinds, F.expr("cast((entity + 2 * n) % 6 + 1 as int)")).alias("action"))


# All fields of a filing as linear forms of a ship quarter: money (rev), quantity (qty), returned lines (back), lines.
FULL_FIELDS: dict[str, str] = {
    "assets": "rev * 2 + qty", "assetsc": "rev * 0.5", "cashneq": "rev * 0.125", "receivables": "rev * 0.0625 + qty", "inventory": "rev * 0.0625 + lines * 10", "ppnenet": "rev * 0.75", "investments": "qty * 8", "liabilities": "rev * 0.75 + back * 500",
    "liabilitiesc": "rev * 0.25 + lines * 100", "debt": "rev * 0.5", "debtnc": "rev * 0.375 + back * 100", "equity": "rev * 1.25 + qty - back * 500", "retearn": "rev * 0.5 - back * 2000", "workingcapital": "rev * 0.25 - lines * 100", "tangibles": "rev - back * 4000",
    "invcap": "rev * 1.5", "sharesbas": "qty * 10", "sharefactor": "CASE WHEN back > 3 THEN 2 ELSE 1 END", "revenue": "rev * f", "gp": "rev * f * 0.5 - qty * 100", "sgna": "rev * 0.125 + lines * 50", "depamor": "rev * 0.0625 + back * 10", "ebit": "rev * 0.25 - lines * 200",
    "ebitda": "rev * 0.3125 - lines * 150", "intexp": "back * 97", "netinc": "rev * 0.25 - qty * back * 50", "ncfo": "rev * 0.125 - back * 1000", "fcf": "rev * 0.0625 - back * 1000", "ncfcommon": "(back - 3) * 100", "ncfdebt": "(lines - 20) * 100", "ncfdiv": "-back * 10",
    "epsdil": "rev * 0.001 - back", "rnd": "CASE WHEN back > 1 THEN qty * 2 END", "capex": "-qty * 30",
}


def full_filings(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """entity, datekey, reportperiod and all fields of ``functions.families``; ``keep`` names inputs to keep, too.

    Sums of a quarter are dealt out by entity before the fields are made of them.
    """
    q = _lines(spark, sf_dir).groupBy("entity", F.trunc("date", "quarter").alias("q")).agg((F.sum("cents") / F.lit(100.0)).alias("rev"), F.sum("qty").cast("double").alias("qty"), F.sum("back").cast("double").alias("back"), F.count("*").cast("double").alias("lines"))
    q = _known(spark, sf_dir, q).repartition("entity")
    q = q.withColumn("reportperiod", F.date_sub(F.add_months("q", 3), 1))
    filed = lambda days, f: F.struct(F.date_add("reportperiod", days).alias("datekey"), F.lit(f).alias("f"))
    each = F.when(F.expr("(year(q) * 4 + quarter(q)) % 7 = 0"), F.array(filed(45, 1.0), filed(115, 1.25))).otherwise(F.array(filed(45, 1.0)))
    return q.select("*", F.inline(each)).selectExpr("entity", "datekey", "reportperiod", *[f"CAST({e} AS DOUBLE) AS {n}" for n, e in FULL_FIELDS.items()], *(keep or []))
