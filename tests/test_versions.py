"""Versions of several relations: all or nothing, whatever stops the write."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources.versions import current, publish, read_relation


def relations(spark, n):
    panel = spark.range(n).select("id", (F.col("id") * 2).alias("x"), (F.col("id") / 2).alias("x_rank"))
    return {"dataset": (panel, ["id"]), "splits": (spark.range(3).select("id", F.lit("train").alias("role")), ["id"])}


GROUPS = {"dataset": {"key": ["id"], "features": ["x"], "ranks": ["x_rank"]}}


def audit(spark, flagged):
    return spark.createDataFrame([("x_rank", flagged), ("y_rank", False)], "column string, flagged boolean")


def test_a_version_is_described(spark, tmp_path):
    root = str(tmp_path / "data")
    assert current(spark, root) is None
    publish(relations(spark, 10), root, "1", {"rank_policy": {"x": "full"}, "input_rows": {"prices": 99}}, audit(spark, False), column_groups=GROUPS)
    m = current(spark, root)
    assert m["version"] == "1" and m["relations"]["dataset"]["rows"] == 10 and m["relations"]["splits"]["rows"] == 3 and m["relations"]["audit"]["rows"] == 2
    assert m["about"]["input_rows"] == {"prices": 99} and m["column_groups"] == GROUPS and not m["accepted_flagged"]
    assert [r.id for r in read_relation(spark, root, "dataset").collect()] == list(range(10))
    with pytest.raises(FileExistsError):
        publish(relations(spark, 5), root, "1", {})
    with pytest.raises(ValueError, match="from x_rank on"):
        publish(relations(spark, 5), root, "2", {}, column_groups={"dataset": {"key": ["id"], "ranks": ["x_rank"], "features": ["x"]}})
    publish(relations(spark, 12), root, "2", {})
    assert current(spark, root)["version"] == "2" and read_relation(spark, root, "dataset").count() == 12


def test_a_write_that_stops_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "data")
    publish(relations(spark, 10), root, "1", {})
    broken = relations(spark, 20) | {"folds": (spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("the machine died"))).otherwise(F.lit("x")).alias("f")), ["f"])}
    with pytest.raises(PySparkException):  # the dataset and the splits are written by then
        publish(broken, root, "2", {})
    assert current(spark, root)["version"] == "1" and read_relation(spark, root, "dataset").count() == 10 and read_relation(spark, root, "splits").count() == 3
    publish(relations(spark, 20), root, "2", {})  # and may be tried again
    assert read_relation(spark, root, "dataset").count() == 20


def test_flagged_versions_are_published_knowingly_only(spark, tmp_path):
    root = str(tmp_path / "data")
    with pytest.raises(ValueError, match="flags 1 columns"):
        publish(relations(spark, 4), root, "1", {}, audit(spark, True))
    assert current(spark, root) is None
    publish(relations(spark, 4), root, "1", {}, audit(spark, True), accept_flagged=True)
    assert current(spark, root)["accepted_flagged"] and read_relation(spark, root, "audit").where("flagged").count() == 1
