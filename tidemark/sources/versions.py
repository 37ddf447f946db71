"""Versions of several relations at once: written aside, described, then made current by one rename.

A version is a folder that no later step changes.  ``CURRENT`` names the one
that readers get; it is replaced only when everything of the new version is
written, so whenever a write stops, readers keep the old version whole.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())  # a pointer or a manifest, some lines


def _point_to(spark: SparkSession, root: str, name: str) -> None:
    """Replace the pointer in one step, whatever it named."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fresh = f"{root}/.{POINTER}-{uuid.uuid4().hex}"
    _write_text(spark, fresh, name)
    _, src = _fs(spark, fresh)
    _, dst = _fs(spark, f"{root}/{POINTER}")
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if src.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(src, dst, how)


def publish(
    relations: dict[str, tuple[DataFrame, list[str]]], root: str, version: str, about: dict[str, Any], audit: DataFrame | None = None, accept_flagged: bool = False, column_groups: dict[str, dict[str, list[str]]] | None = None
) -> str:
    """Write ``relations`` {name: (rows, sort by)} as ``version`` and make it current; the version's folder.

    ``audit`` has a row for each audited column and a boolean ``flagged``; it
    becomes a relation of the version.  Flagged columns stop the publishing,
    unless ``accept_flagged`` says that this is known: the manifest then says
    so.  ``about`` (rank policy, feature versions, input rows) goes into the
    manifest as it is; ``column_groups`` {relation: {group: columns}} must be
    the relation's columns, group by group, in order.  Numbers of rows come
    from the writes themselves.  A version that is current already isn't
    written again (FileExistsError).
    """
    spark = next(iter(relations.values()))[0].sparkSession
    now = current(spark, root)
    if now is not None and now["version"] == version:
        raise FileExistsError(f"{root}: version {version} is current")
    for name, groups in (column_groups or {}).items():
        flat = [c for cols in groups.values() for c in cols]
        if flat != relations[name][0].columns:
            odd = next((a or b for a, b in zip([*flat, *[None] * len(relations[name][0].columns)], relations[name][0].columns, strict=False) if a != b), flat[-1] if flat else "nothing")
            raise ValueError(f"{name}: the columns aren't those of its groups, from {odd} on")
    folder = f"v{version}-{uuid.uuid4().hex[:12]}"
    parts = dict(relations)
    if audit is not None:
        parts["audit"] = (audit, ["column"])
    found: dict[str, Any] = {}
    for name, (df, sort_by) in parts.items():
        seen = Observation()
        flagged = F.count_if("flagged") if name == "audit" else F.lit(0).cast("long")
        out = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.lit(0)).alias("zero") if name != "audit" else flagged.alias("flagged"))
        out.write.option("compression", "zstd").parquet(f"{root}/{folder}/{name}")
        found[name] = {"rows": int(seen.get["rows"]), "sort_by": sort_by, "columns": df.columns, "flagged": int(seen.get["flagged"] or 0) if name == "audit" else 0}
    if found.get("audit", {}).get("flagged") and not accept_flagged:
        raise ValueError(f"the audit flags {found['audit']['flagged']} columns; see {root}/{folder}/audit")
    manifest = {"version": version, "folder": folder, "relations": found, "column_groups": column_groups or {}, "accepted_flagged": bool(found.get("audit", {}).get("flagged")), "about": about}
    _write_text(spark, f"{root}/{folder}/manifest.json", json.dumps(manifest, sort_keys=True))
    _point_to(spark, root, folder)
    return f"{root}/{folder}"


def current(spark: SparkSession, root: str) -> dict[str, Any] | None:
    """The manifest of the current version, None if there is none."""
    name = _read_text(spark, f"{root}/{POINTER}")
    if name is None:
        return None
    text = _read_text(spark, f"{root}/{name}/manifest.json")
    if text is None:
        raise FileNotFoundError(f"{root}/{name}/manifest.json")
    return json.loads(text)


def read_relation(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A relation of the current version."""
    now = current(spark, root)
    if now is None:
        raise FileNotFoundError(f"{root} has no version")
    return spark.read.parquet(f"{root}/{now['folder']}/{name}")
