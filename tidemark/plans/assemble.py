"""Joining feature families, labels and weights to one panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["entity", "quarter", "kind"]


def check_aligned(*parts: DataFrame, key: list[str] = KEY) -> None:
    """Every part must have the same keys, each once; one aggregation over their union finds out."""
    n = len(parts)
    union = None
    for i, p in enumerate(parts):
        one = p.select(*key, F.lit(i).alias("part"))
        union = one if union is None else union.unionByName(one)
    bad = union.groupBy(*key).agg(F.count("*").alias("c"), F.count_distinct("part").alias("k")).where((F.col("c") != n) | (F.col("k") != n)).limit(1).count()
    if bad:
        raise ValueError(f"the parts of the panel don't have the same {key}")


def assemble(features: DataFrame, labels: DataFrame, weights: DataFrame, key: list[str] = KEY) -> DataFrame:
    """All feature rows; labels and weights where they are observable, else null."""
    return features.join(labels, key, "left").join(weights.select(*key, "weight"), key, "left")
