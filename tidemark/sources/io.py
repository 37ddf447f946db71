"""Typed CSV and Parquet sources, sorted sinks, immutable dataset versions and their manifests."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, _parse_datatype_string


@dataclass(frozen=True)
class TableSpec:
    """A raw table: which columns have a type other than double, and how its rows are sorted."""

    name: str
    types: dict[str, str] = field(default_factory=dict)
    sort_by: tuple[str, ...] = ()
    description: str = ""


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Names in the header; without a schema to infer, only the first line is read."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """CSV with a header and an explicit schema: the spec's types, double otherwise; types of absent columns are ignored."""
    fields = [StructField(c, _parse_datatype_string(spec.types[c]) if c in spec.types else DoubleType()) for c in csv_columns(spark, path)]
    return spark.read.schema(StructType(fields)).option("header", True).csv(path)


def sorted_parquet(df: DataFrame, path: str, sort_by: list[str], mode: str = "errorifexists") -> int:
    """Write zstd Parquet in ranges of ``sort_by``, sorted inside, so that row groups can be skipped; the number of rows.

    The count comes from the write itself (beyond the range sampling, which reads rows twice).
    """
    seen = Observation()
    out = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "zstd").parquet(path)
    return int(seen.get["n"])


REJECTED = "_rejected_line"


def header_drift(spark: SparkSession, path: str, spec: TableSpec) -> dict[str, list[str]]:
    """What the header of a CSV file lacks of the spec: typed columns that are ``absent``, and ``unsorted`` ones that rows should be sorted by; names that stand ``twice``."""
    names = spark.read.text(path).first()  # the reader renames repeated names, so the line itself is split
    raw = [] if names is None else [n.strip().strip('"') for n in names[0].split(",")]
    return {
        "absent": [c for c in spec.types if c not in raw],
        "unsorted": [c for c in spec.sort_by if c not in raw],
        "twice": sorted({n for n in raw if raw.count(n) > 1}),
    }


def read_csv_checked(spark: SparkSession, path: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the spec, and the rest: every column as far as it could be read, with the line itself in ``REJECTED``.

    A line is rejected if a cell doesn't parse as its column's type or if it
    has more or fewer cells than the header; empty cells are null and fit.
    """
    fields = [StructField(c, _parse_datatype_string(spec.types[c]) if c in spec.types else DoubleType()) for c in csv_columns(spark, path)]
    schema = StructType([*fields, StructField(REJECTED, StringType())])
    rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    good = rows.where(F.col(REJECTED).isNull()).select(*[F.col(f"`{f.name}`") for f in fields])
    return good, rows.where(F.col(REJECTED).isNotNull())


def ingest_csv(spark: SparkSession, csv_path: str, out_path: str, spec: TableSpec, most_rejected: int = 0) -> dict:
    """Publish a CSV file as sorted Parquet in one step: n_rows, n_rejected, drift.

    Rows go to a staging folder beside ``out_path``, rejected lines to
    ``{out_path}.rejected`` (as Parquet, replaced each time).  More than
    ``most_rejected`` of them, or a column missing that rows are sorted by or
    one that stands twice, raise ValueError and leave what stood at
    ``out_path`` as it was.  Else the staging folder takes its place by
    renames, so that readers that open it later see the old table or the new
    one.  Typed columns that the file lacks are reported, not made.
    """
    drift = header_drift(spark, csv_path, spec)
    if drift["unsorted"] or drift["twice"]:
        raise ValueError(f"{csv_path}: no {', '.join(drift['unsorted']) or 'column missing'}; twice {', '.join(drift['twice']) or 'none'}")
    good, bad = read_csv_checked(spark, csv_path, spec)
    seen = Observation()
    bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out_path}.rejected")
    n_bad = int(seen.get["n"])
    if n_bad > most_rejected:
        raise ValueError(f"{csv_path}: {n_bad} lines don't fit, {most_rejected} may; see {out_path}.rejected")
    staging, old = f"{out_path}.staging", f"{out_path}.replaced"
    n = sorted_parquet(good, staging, list(spec.sort_by), "overwrite")
    fs, to = _paths(spark, out_path)
    fs.delete(_paths(spark, old)[1], True)
    if fs.exists(to) and not fs.rename(to, _paths(spark, old)[1]):
        raise OSError(f"{out_path} can't be moved away")
    if not fs.rename(_paths(spark, staging)[1], to):
        fs.rename(_paths(spark, old)[1], to)
        raise OSError(f"{staging} can't be renamed")
    fs.delete(_paths(spark, old)[1], True)
    return {"n_rows": n, "n_rejected": n_bad, "drift": drift}


def csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, spec: TableSpec, mode: str = "errorifexists") -> int:
    return sorted_parquet(read_csv(spark, csv_path, spec), out_path, list(spec.sort_by), mode)


def _shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session that has none gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        set_to = sc.getConf().get("spark.checkpoint.dir", None)
        if set_to is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(set_to or tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder ``spark.checkpoint.dir`` and read back, for relations that many steps of a query use.

    Only a local session that has no such folder gets a temporary one.
    """
    path = f"{_shared_folder(df.sparkSession)}/relation-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: list[str], buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """``df`` written once, dealt into ``buckets`` by ``by`` and sorted in them: joins, windows and unions of such tables on ``by`` shuffle nothing.

    ``buckets`` is the session's number of shuffle partitions unless given;
    tables that are to be joined need the same.  The table lies in the shared
    folder under a name of its own and is dropped from the catalog with the
    session (its files stay, as those of ``materialized``).  ``dealt`` says that
    rows lie by ``by`` already.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    # a task writes one bucket, so there are as many files as buckets; rows that are ``dealt`` out by ``by`` already stay in their task
    (df if dealt else df.repartition(n, *by)).write.bucketBy(n, *by).sortBy(*by).format("parquet").option("compression", "zstd").option("path", f"{_shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def csv_report(df: DataFrame, path: str, order: list[str]) -> None:
    """A small report as one CSV file with a header."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_relation(df: DataFrame, name: str, parquet_dir: str, sort_by: list[str], csv_dir: str | None = None) -> int:
    """A named relation as sorted Parquet and, if asked for, as one CSV file; the number of rows."""
    n = sorted_parquet(df, f"{parquet_dir}/{name}", sort_by, "overwrite")
    if csv_dir:
        csv_report(df.sparkSession.read.parquet(f"{parquet_dir}/{name}"), f"{csv_dir}/{name}", sort_by)
    return n


def write_inference(df: DataFrame, root: str, as_of: str, columns: list[str], sort_by: list[str], stale: str) -> str:
    """``root/inference_{as_of}`` with the panel, whose columns must be ``columns``, and a manifest: rows, rows whose flag or age ``stale`` is above 0."""
    path = f"{root}/inference_{as_of}"
    fs, p = _paths(df.sparkSession, path)
    if fs.exists(p):
        raise FileExistsError(path)
    sorted_parquet(exact_columns(df, columns, "the panel"), f"{path}/panel", sort_by)
    seen = df.sparkSession.read.parquet(f"{path}/panel").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(stale).cast("int") > 0).alias("n_stale"))
    seen.select(F.lit(as_of).alias("as_of"), "*", F.array(*map(F.lit, columns)).alias("columns")).coalesce(1).write.json(f"{path}/manifest")
    return path


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df


def exact_columns(df: DataFrame, names: list[str], what: str = "family") -> DataFrame:
    """The columns must be ``names`` in this order."""
    if df.columns != list(names):
        raise ValueError(f"{what} has {df.columns}, not {list(names)}")
    return df


def manifest(df: DataFrame, version: str, entity: str, weights: list[str]) -> DataFrame:
    """One row about a written dataset: rows, entities, sums of the weights, columns."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(entity).alias("n_entities"), *[F.sum(w).alias(f"effective_{w}") for w in weights]]
    return df.agg(*aggs).select(F.lit(version).alias("version"), "*", F.array(*map(F.lit, df.columns)).alias("columns"))


def _paths(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_version(df: DataFrame, root: str, version: str, sort_by: list[str], entity: str, weights: list[str], gate: DataFrame | None = None, force: bool = False) -> str:
    """Write ``root/dataset_v{version}`` once: into a staging folder, audited there, then renamed.

    ``gate`` has a boolean column ``flagged``; a flagged row stops the write
    and the staging folder stays for inspection.  An existing version is
    refused unless ``force``.
    """
    spark = df.sparkSession
    final, staging = f"{root}/dataset_v{version}", f"{root}/.staging_v{version}"
    fs, to = _paths(spark, final)
    if fs.exists(to) and not force:
        raise FileExistsError(final)
    sorted_parquet(df, f"{staging}/dataset", sort_by, "overwrite")
    if gate is not None:
        gate.write.mode("overwrite").parquet(f"{staging}/audit")
        if spark.read.parquet(f"{staging}/audit").where("flagged").limit(1).count():
            raise ValueError(f"the audit flags columns; see {staging}/audit")
    manifest(spark.read.parquet(f"{staging}/dataset"), version, entity, weights).coalesce(1).write.mode("overwrite").json(f"{staging}/manifest")
    replaced = _paths(spark, f"{root}/.replaced_v{version}")[1]
    if fs.exists(to) and not fs.rename(to, replaced):
        raise OSError(f"{final} can't be moved away")
    if not fs.rename(_paths(spark, staging)[1], to):
        fs.rename(replaced, to)  # the old version stays what it was
        raise OSError(f"{staging} can't be renamed")
    fs.delete(replaced, True)
    return final


def provenance(spark: SparkSession, table: str, n_rows: int, sort_by: list[str], path: str) -> None:
    """Append a record about an ingested table to a metadata table."""
    row = spark.range(1).select(F.lit(table).alias("table"), F.lit(n_rows).cast("long").alias("n_rows"), F.array(*map(F.lit, sort_by)).cast("array<string>").alias("sort_by"), F.current_timestamp().alias("ingested_at"))
    row.write.mode("append").parquet(path)
