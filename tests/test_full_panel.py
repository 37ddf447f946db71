"""The full panel writes its features once and deals out only what doesn't lie by entity."""

import os

import pytest

from tidemark.plans import wide
from tidemark.plans.queries import QUERIES
from tidemark.sources import io

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
def test_parts_meet_within_their_entity(spark, monkeypatch):
    written = []
    keep = lambda df, by, *a, **k: written.append(df.columns) or io.bucketed(df, by, *a, **k)
    monkeypatch.setattr(wide, "bucketed", keep)
    monkeypatch.setattr("tidemark.plans.queries.bucketed", keep)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as of large tables
        plan = QUERIES["full_panel"](spark, SF)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("roa" in cols for cols in written) == 1 and not any("roa_rank" in cols or "cagr_1y" in cols or "weight_1y" in cols for cols in written)
    assert "hashpartitioning(entity" in plan and not any("quarter" in x for x in plan.split("\n") if "hashpartitioning(entity" in x)
