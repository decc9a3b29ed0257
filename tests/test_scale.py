"""What a task holds, and how often a step is computed, doesn't grow with the number of rows."""

from __future__ import annotations

import re

import numpy as np
import pytest

from trendloom import vocab
from trendloom.operators import axes, emergence, palette
from trendloom.plans import all_queries
from trendloom.sources import bindings, scratch

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pixels_are_counted_before_python(spark):
    rng = np.random.default_rng(3)
    colors = rng.uniform(0, 100, (40, 3)).round(1)
    pts = colors[rng.choice(40, 3000, p=rng.dirichlet(np.ones(40)))]
    pixels = spark.createDataFrame([("g", *map(float, x)) for x in pts] + [("h", 1.0, 2.0, 3.0)], "by string, l double, a double, b double")
    out = palette.pixel_palettes(pixels, "by")
    pts = pts[np.lexsort(pts.T[::-1])]
    c, label = palette.kmeans(pts, np.ones(len(pts)), 5)  # every pixel by itself
    n = np.bincount(label, minlength=5)
    order = np.argsort(-n, kind="stable")
    got = out.filter("by = 'g'").orderBy("rank").collect()
    assert np.array([(r.l, r.a, r.b) for r in got]) == pytest.approx(c[order]) and [r.share for r in got] == pytest.approx(n[order] / 3000)
    assert [(r.l, r.share) for r in out.filter("by = 'h'").collect()] == [(1.0, 1.0)]
    sent = plan(out).split("FlatMapGroupsInPandas")[1]
    assert "HashAggregate" in sent and "count" in sent


def test_small_palettes_merge_as_one_by_one(spark):
    rng = np.random.default_rng(5)
    for n in range(1, palette.SMALL):
        lab, weight, family = rng.uniform(0, 30, (200, n, 3)).round(), rng.integers(1, 4, (200, n)).astype(float), rng.integers(-1, len(vocab.COLOR_FAMILIES), (200, n))
        many = palette.merge_many(lab, weight, family, 10.0)
        for i in range(200):
            one = palette.merge_colors(lab[i], weight[i], [vocab.COLOR_FAMILIES[f] if f >= 0 else None for f in family[i]], 10.0)
            alive = many[1][i] > 0
            assert (many[0][i][alive] == one[0]).all() and (many[1][i][alive] == one[1]).all() and [vocab.COLOR_FAMILIES[f] if f >= 0 else None for f in many[2][i][alive]] == one[2]
    rows = spark.createDataFrame([(g, f"#{x:06X}", float(1 + x % 5)) for g, m in (("few", 5), ("many", 40)) for x in rng.integers(0, 1 << 24, m).tolist()], "g string, hex string, weight double")
    got = {g: sorted((r.rank, r.share) for r in palette.group_palettes(rows, "g").collect() if r.g == g) for g in ("few", "many")}
    assert all(v and abs(sum(s for _, s in v) - 1) < 1e-9 and [r for r, _ in v] == list(range(1, len(v) + 1)) for v in got.values())


@pytest.mark.parametrize("name", bindings.BY_ITEM)
def test_lines_are_dealt_by_item_once(spark, name):
    own, plain = bindings.relation(spark, SF, name), bindings.relation(spark, SF, name, by_item=False)
    assert own.columns == plain.columns and own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
    counted = plan(own.groupBy("item_id").count())
    assert counted.count("hashpartitioning(item_id") == counted.count("REPARTITION_BY_NUM") == 1 or name == "tags"


def test_parts_grow_with_the_files(spark, tmp_path, monkeypatch):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert bindings.parts(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(bindings, "PART_BYTES", 10_000)
    assert bindings.parts(df) > 20


def test_tag_counters_shuffle_items_once(spark):
    cleaned = spark.createDataFrame([("1", "a", True), ("1", "b", False), ("1", "b", False), ("2", "b", False), ("3", "b", None)], "item_id string, tag string, known boolean").repartition(3, "item_id")
    out = emergence.post_counters(cleaned)
    assert {(r.tag, r.n_posts, r.n_fashion) for r in out.collect()} == {("a", 1, 1), ("b", 3, 1)}
    assert "Join" not in plan(out)


def test_representatives_count_items_before_the_shuffle(spark):
    contrib = spark.createDataFrame([("1", "instagram", "c", 1.0), ("1", "instagram", "c", 2.0), ("2", "youtube", "c", 1.0)], "item_id string, source string, cluster string, contribution double").repartition(3, "item_id")
    out = axes.representatives(contrib)
    assert out.first().asDict() == {"cluster": "c", "total": 4.0, "ig_share": 0.75, "yt_share": 0.25, "n_items": 2}
    assert "hashpartitioning(cluster#" in plan(out) and not re.search(r"hashpartitioning\(cluster#\d+, item_id", plan(out))


def test_emitted_tables_start_from_kept_items(spark, monkeypatch):
    kept, read = [], []
    keep, lines = scratch.kept, bindings.relation
    monkeypatch.setattr(scratch, "kept", lambda df, tag: kept.append(tag) or keep(df, tag))
    monkeypatch.setattr(bindings, "relation", lambda s, d, name, *a, **b: read.append(name) or lines(s, d, name, *a, **b))
    all_queries.QUERIES["B9_emit_items"](spark, SF).count()
    assert kept == ["items"] and read.count("groups") == 1
    for name, tag in (("K6_signal_latest", "found"), ("K7_tag_week_latest", "made"), ("B10_emit_representatives", "made"), ("J11_history_update", "batch")):
        kept.clear()
        all_queries.QUERIES[name](spark, SF)
        assert tag in kept
