from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from trendloom.config import SCORING, target_date
from trendloom.operators import distributions, history


def test_target_date():
    today = date(2026, 1, 3)
    assert target_date("2026-01-01", "2026-01-02", today).day == 1 and target_date(None, "2026-01-02", today).day == 2 and target_date(None, None, today) == today


def test_festival_days():
    first, last, tags = SCORING.festivals[0]
    assert SCORING.active_festival_tags(first) == SCORING.active_festival_tags(last) == tags and SCORING.active_festival_tags(date(2000, 1, 1)) == ()


def test_old_formats(spark):
    rows = spark.createDataFrame([("a", "1", "12.5"), ("b", "1", '{"score": 3.0, "post_count": 2}'), ("c", "1", None), ("d", "1", "{broken")], "cluster string, d string, e string")
    got = {r.cluster: (r.score, r.posts, r.views) for r in history.readable(rows, "cluster", "d", "e").collect()}
    assert got["a"] == (12.5, 0.0, 0.0) and got["b"] == (3.0, 2.0, 0.0) and got["c"][0] is None and got["d"][0] is None


def test_rest(spark):
    dists = spark.createDataFrame([("x", "a", 0.5), ("x", "b", 0.2), ("y", "a", 1.0)], "cluster string, value string, pct double")
    got = {(r.cluster, r.value): round(r.pct, 9) for r in distributions.with_rest(dists, "cluster").filter(F.col("value") == "etc").collect()}
    assert got == {("x", "etc"): 0.3}
