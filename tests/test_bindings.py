"""The bound relations hold every row of their tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom.sources import bindings

SF = "/root/testdata/sf0.001"


def test_relations_keep_all_rows(spark):
    rows = lambda name: bindings.table(spark, SF, name).count()
    of = lambda name: bindings.relation(spark, SF, name)
    assert of("snapshots").count() == rows("events")
    assert of("brands").count() == rows("supplier")
    assert of("item_brands").count() == rows("lineitem")
    assert of("history").agg(F.sum("posts")).first()[0] == rows("events")
    assert of("weekly").agg(F.sum("n")).first()[0] == rows("lineitem")
