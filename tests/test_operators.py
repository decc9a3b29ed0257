"""Operators on tiny tables against hand-computed values."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import SCORING
from trendloom.operators import axes, dedup, distributions, emergence, history, palette, ranking, scoring, snapshots, text

GROUP = "item_id string, canonical_index int, n_objects long, area double, garment string, fabric string, is_ethnic boolean, weight double"


def weighed(spark, rows):
    """rows: item, n, area, garment, fabric."""
    df = spark.createDataFrame([(i, k, n, a, g, f) for k, (i, n, a, g, f) in enumerate(rows)], "item_id string, canonical_index int, n_objects long, area double, garment string, fabric string")
    from trendloom.functions import columns as C

    return df.withColumn("is_ethnic", F.lit(True)).withColumn("weight", C.group_weight(F.col("n_objects"), F.col("area")))


SPEC = [("i", 4, 0.35, "kurta", "cotton"), ("i", 2, 0.20, "kurta", "cotton"), ("i", 1, 0.40, "kurta", "georgette"), ("i", 3, 0.15, "kurta", "satin"), ("i", 1, 0.30, "kurta", "silk")]
MIXED = [("i", 3, 0.5, "a", "b"), ("i", 1, 0.25, "c", "d"), ("i", 2, 0.1, None, None)]


def test_fanout(spark):
    got = {r.cluster: r.share for r in axes.fanout_normalized(weighed(spark, SPEC)).collect()}
    assert got == pytest.approx({"kurta__cotton": 0.508773, "kurta__georgette": 0.143720, "kurta__satin": 0.214606, "kurta__silk": 0.132900}, abs=1e-6)
    mass = sorted(r.share for r in axes.fanout_mass(weighed(spark, SPEC)).collect())
    assert mass == pytest.approx(sorted([1.154435, 0.669498, 0.515232, 0.769355, 0.476442]), abs=1e-6)


def test_groups_without_axes_weigh_in_mass_only(spark):
    g = weighed(spark, MIXED)
    assert sorted(r.share for r in axes.fanout_normalized(g).collect()) == pytest.approx([0.292948, 0.707052], abs=1e-6)
    assert sorted(r.share for r in axes.fanout_mass(g).collect()) == pytest.approx([0.612950, 1.479398], abs=1e-6)
    corrected = axes.fanout_mass(g, drop_before_total=True)
    assert corrected.agg(F.sum("share")).first()[0] == pytest.approx(np.log2(5), abs=1e-6)


def test_partial_and_missing_axes(spark):
    got = axes.fanout_mass(weighed(spark, [("i", 1, 0.3, None, "silk"), ("j", 1, 0.3, None, None), ("k", 0, 0.0, "a", "b")])).collect()
    assert {(r.item_id, r.cluster, r.share) for r in got} == {("i", "unknown__silk", 1.0), ("k", "a__b", 0.0)}


def test_representatives_and_evidence(spark):
    items = spark.createDataFrame([("1", "instagram"), ("2", "youtube")], "item_id string, source string")
    fan = spark.createDataFrame([("1", "a__b", 1.0), ("2", "a__b", 1.0)], "item_id string, cluster string, share double")
    contrib = axes.contributions(fan, items)
    r = axes.representatives(contrib).first()
    assert (r.total, r.ig_share, r.yt_share, r.n_items) == (5.0, 0.5, 0.5, 2)
    assert axes.effective_items(contrib).first()[0] == 2.0
    rows = spark.createDataFrame([("c", "s", x, v) for x, v in (("a", 1.0), ("b", 3.0), ("c", 2.0), ("d", 4.0), ("e", 3.0))], "cluster string, source string, item_id string, contribution double")
    assert [r.item_id for r in axes.evidence(rows, 3).orderBy("rank").collect()] == ["d", "b", "e"]


def test_cross_fanout(spark):
    g = spark.createDataFrame([("1", "kurta", 0.7), ("1", "saree", 0.3), ("2", "kurta", 1.0)], "item_id string, value string, pct double")
    f = spark.createDataFrame([("1", "cotton", 0.6), ("1", "silk", 0.4)], "item_id string, value string, pct double")
    got = {(r.item_id, r.cluster): r.share for r in axes.cross_fanout(g, f).collect()}
    assert got[("1", "kurta__cotton")] == pytest.approx(0.42) and got[("2", "kurta__unknown")] == 0.5 and len(got) == 5


def test_item_distribution(spark):
    g = weighed(spark, [("i", 2, 0.5, "saree", None)])
    txt = spark.createDataFrame([("i", "kurta", "rule"), ("j", "tunic", "vlm")], "item_id string, value string, method string")
    got = {(r.item_id, r.value): r.pct for r in distributions.item_distribution(g, "garment", txt).collect()}
    assert got == pytest.approx({("i", "kurta"): 0.791039, ("i", "saree"): 0.208961}, abs=1e-6)
    only = distributions.item_distribution(weighed(spark, [("i", 5, 0.9, None, None), ("i", 1, 0.2, "a", None)]), "garment").collect()
    assert [(r.value, r.pct) for r in only] == [("a", 1.0)]


def test_brand_distribution(spark):
    fan = spark.createDataFrame([("1", "c", 1.0), ("2", "c", 1.0)], "item_id string, cluster string, share double")
    brands = spark.createDataFrame([("1", "A")] + [("2", f"B{i}") for i in range(5)] + [("2", "B0")], "item_id string, name string")
    got = [(r.name, r.pct) for r in distributions.brand_distribution(fan, brands).orderBy("rank").collect()]
    assert [n for n, _ in got] == ["A", "B0", "B1", "B2", "B3"] and got[0][1] == pytest.approx(0.763661, abs=1e-6) and got[1][1] == pytest.approx(0.059085, abs=1e-6)


def test_weighted_average(spark):
    d = spark.createDataFrame([("k", "p1", "a", 0.6, 10.0), ("k", "p1", "b", 0.4, 10.0), ("k", "p2", "a", 0.2, 30.0), ("k", "p2", "b", 0.8, 30.0)], "kind string, period string, value string, pct double, weight double")
    assert {r.value: round(r.pct, 6) for r in distributions.weighted_average(d, "kind").collect()} == {"a": 0.3, "b": 0.7}


def test_scores(spark):
    raw = spark.createDataFrame([("a", 1.0, 10.0, 5.0, 0.0, 0.0), ("b", 1.0, 100.0, 5.0, 1.0, 0.0)], "cluster string, posts double, f_social double, f_youtube double, f_cultural double, f_momentum double")
    got = {r.cluster: (r.social, r.youtube, r.cultural, r.score) for r in scoring.scores(raw).collect()}
    assert got == {"a": (0.0, 0.0, 0.0, 0.0), "b": (40.0, 0.0, 15.0, 55.0)}
    acc = spark.createDataFrame([("a", 0.0, 10.0, 100.0, 1.0, 1.0, 2.0, 0.5, 0.2, 0.1, 0.05, 2.0)], "cluster string, social double, videos double, views double, posts double, presence double, view_growth double, post_growth double, velocity double, new_ig double, new_yt double, festival double")
    r = scoring.raw_factors(acc).first()
    assert (r.f_youtube, r.f_cultural, r.f_momentum) == pytest.approx((43.6, 1.6, 0.2825))
    boosted = scoring.display_boost(scoring.scores(raw)).filter("cluster = 'b'").first()
    assert boosted.score == 100.0 and boosted.social == pytest.approx(40 * 100 / 55)
    assert SCORING.festival_boost == 1.5


def test_growth(spark):
    t = lambda d: datetime(2026, 1, d)
    rows = [("i", "a", 1, t(1), 100), ("i", "a", 2, t(11), 300), ("i", "b", 3, t(1), 5), ("i", "c", 4, t(1), 5), ("i", "c", 5, t(1), 9), ("i", "d", 6, t(2), 50), ("i", "d", 7, t(4), 70), ("i", "e", 8, t(2), 50), ("i", "e", 9, t(4), 40), ("i", "f", 10, None, 1)]
    snaps = spark.createDataFrame(rows, "source string, url_tag string, snapshot_id long, collected_at timestamp, metric long")
    rates = snapshots.growth_rate(snaps)
    assert {r.url_tag: r.rate for r in rates.collect()} == {"a": 20.0, "d": 10.0, "e": -5.0}
    assert {r.url_tag: r.factor for r in snapshots.growth_factor(rates).collect()} == {"a": 2.0, "d": 1.5, "e": 1.0}


def test_snapshot_dedup(spark):
    t = lambda d: datetime(2026, 1, d)
    items = spark.createDataFrame([("1", "x", t(1), 9, 0), ("2", "x", t(2), 1, 0), ("3", "x", t(2), 1, 1), ("4", None, t(1), 0, 0), ("5", None, t(1), 0, 0)], "item_id string, url_tag string, posted_at timestamp, likes long, comments long")
    items = items.withColumn("source", F.lit("instagram")).withColumn("views", F.lit(0))
    assert {r.item_id for r in snapshots.dedup(items).collect()} == {"3", "4", "5"}
    assert {r.item_id for r in snapshots.dedup_by_engagement(items).collect()} == {"1", "4", "5"}


def test_history(spark):
    h = spark.createDataFrame([("c", date(2026, 1, d), p, 10 * p, p, float(p)) for d, p in ((1, 7), (5, 7), (8, 10), (16, 4))], "cluster string, d date, posts long, views long, tags long, score double")
    got = {str(r.d): r for r in history.day_features(h).collect()}
    assert got["2026-01-08"].base == 7.0 and got["2026-01-08"].post_growth == pytest.approx(4.0) and got["2026-01-08"].change_pct == pytest.approx(300 / 7)
    assert got["2026-01-16"].base is None and got["2026-01-16"].change_pct == 0 and got["2026-01-16"].post_growth == 0 and got["2026-01-16"].posts_before == 24
    # days 9..15 have no views, days 2..8 have 170
    assert got["2026-01-16"].view_growth == pytest.approx(-1.0)
    assert got["2026-01-01"].posts_before == 0


def test_new_entities_count_duplicates(spark):
    a = spark.createDataFrame([("c", date(2026, 1, 9), "n"), ("c", date(2026, 1, 9), "n"), ("c", date(2026, 1, 9), "o"), ("c", date(2026, 1, 1), "o"), ("c", date(2025, 1, 1), "n")], "cluster string, d date, account string")
    assert history.new_entity_ratio(a, "2026-01-09").first().ratio == pytest.approx(2 / 3)


def test_trajectory(spark):
    w = spark.createDataFrame([("c", date(2026, 4, 13), 10.0), ("c", date(2026, 4, 20), 20.0), ("c", date(2026, 4, 27), 30.0)], "cluster string, week date, score double")
    t = history.trajectory(w, "2026-04-27")
    assert t.first()["values"] == [0.0] * 9 + [10.0, 20.0, 30.0]
    arr = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    r = spark.range(1).select(history.streak(arr(0, 30, 40, 50, 60)), history.streak(arr(0, 0, 50)), history.streak_direction(arr(1, 50, 40)), history.within_band(arr(0, 10, 11, 12), 3, 10, 12), history.within_band(arr(10, 13, 11), 3, 10, 12)).first()
    assert list(r) == [3, 0, "down", True, False]
    m = history.monthly_average(spark.createDataFrame([("c", date(2026, 4, 20), 30.0), ("c", date(2026, 4, 27), 40.0)], "cluster string, week date, score double")).first()
    assert m.avg_score == 17.5


def test_latest_keeps_ties(spark):
    rows = spark.createDataFrame([("ig", "t1", 1), ("ig", "t1", 2), ("ig", "t1", 2), ("ig", None, 1)], "source string, tag string, computed_at int")
    got = history.latest(rows, [F.col("source"), F.coalesce("tag", F.lit("d"))], "computed_at").collect()
    assert sorted((str(r.tag), r.computed_at) for r in got) == [("None", 1), ("t1", 2), ("t1", 2)]


def _posts(spark, n, base=False, extra_unknown=False):
    tags = [(f"p{i}", "#NewThing") for i in range(n)] + [(f"p{i}", "#kurtaset") for i in range(n) if not extra_unknown] + [("p0", "#reelsindia")]
    items = [(f"p{i}", "instagram", datetime(2026, 4, 20 + i % 6, 12)) for i in range(n)]
    if base:
        tags.append(("old", "newthing"))
        items.append(("old", "instagram", datetime(2026, 3, 20)))
    return emergence.clean_tags(spark.createDataFrame(tags, "item_id string, tag string"), spark.createDataFrame(items, "item_id string, source string, posted_at timestamp"))


def test_emergence(spark):
    got = emergence.signals(_posts(spark, 6), date(2026, 4, 26)).collect()
    assert [(r.tag, r.spike, str(r.first_seen), r.n_posts) for r in got] == [("newthing", 6, "2026-04-20", 6)]
    assert emergence.signals(_posts(spark, 6, base=True), date(2026, 4, 26)).isEmpty()
    assert emergence.signals(_posts(spark, 4), date(2026, 4, 26)).isEmpty()
    assert emergence.signals(_posts(spark, 6, extra_unknown=True), date(2026, 4, 26)).isEmpty()
    assert "kurtaset" in vocab.known_tags() and "reelsindia" not in [r.tag for r in _posts(spark, 1).collect()]


def test_mentions(spark):
    texts = spark.createDataFrame([("1", "by @Abc and @x and @abc @Zed.1"), ("2", None)], "item_id string, caption string")
    brands = spark.createDataFrame([("abc", "B1", "mid"), ("zed.1", "B2", "value")], "handle string, brand_id string, tier string")
    assert {(r.brand_id, r.pos) for r in text.brand_mentions(texts, brands).collect()} == {("B1", 0), ("B2", 2)}


def test_picks(spark):
    fan = spark.createDataFrame([("1", "X", 0.6), ("1", "Y", 0.3), ("1", "Z", 0.05), ("2", "X", 1.0), ("3", "unclassified", 1.0)], "item_id string, cluster string, share double")
    items = spark.createDataFrame([("1", "instagram", 5, 1, 0, 1), ("2", "instagram", 5, 1, 0, 2), ("3", "instagram", 5, 1, 0, 3)], "item_id string, source string, likes long, comments long, views long, seq long")
    videos = spark.createDataFrame([("v", "X", 1.0), ("w", "X", 1.0)], fan.schema), spark.createDataFrame([("v", "youtube", 9, 0, 1, 4), ("w", "youtube", 1, 0, 50, 5)], items.schema)
    assert {(r["rank"], r.item_id) for r in ranking.cluster_picks(*videos).collect()} == {(1, "w")}  # views count, one for each cluster
    assert {(r.cluster, r["rank"], r.item_id) for r in ranking.cluster_picks(fan, items).collect()} == {("X", 1, "1"), ("X", 2, "2"), ("Y", 1, "1")}
    assert {(r.item_id, r.cluster) for r in ranking.winner(fan.unionByName(fan.limit(0))).collect()} == {("1", "X"), ("2", "X"), ("3", "unclassified")}


def test_merge_colors():
    lab, weight, family = palette.merge_colors(np.array([[50.0, 0, 0], [52.0, 0, 0], [90.0, 0, 0], [59.9, 0, 0]]), np.array([1.0, 3.0, 1.0, 1.0]), ["earth", "jewel", "pastel", None], 10.0)
    assert len(weight) == 2 and weight.tolist() == [5.0, 1.0] and family == ["jewel", "pastel"] and lab[0][0] == pytest.approx((50 + 156 + 59.9) / 5)
    assert len(palette.merge_colors(np.array([[0.0, 0, 0], [10.0, 0, 0]]), np.ones(2), [None, None], 10.0)[1]) == 2
    assert palette.largest(np.array([1.0, 96.0, 3.0]), 0.05, 5).tolist() == [1] and palette.largest(np.zeros(2), 0.05, 5).tolist() == []


def test_group_palettes(spark):
    rows = spark.createDataFrame([("c", "#FF0000", 3.0), ("c", "#FE0101", 1.0), ("c", "#0000FF", 4.0), ("c", "#00FF00", 0.1)], "cluster string, hex string, weight double")
    got = palette.group_palettes(rows, "cluster").orderBy("rank").collect()
    assert [r.share for r in got] == pytest.approx([0.5, 0.5]) and len(got) == 2


def test_kmeans():
    pts = np.concatenate([np.random.default_rng(0).normal(c, 1, (100, 3)) for c in (0, 50)])
    c, label = palette.kmeans(pts, np.ones(200), 2)
    assert len(set(label[:100])) == 1 and len(set(label)) == 2 and abs(c.mean() - 25) < 1


def test_outfit_unions(spark):
    same = ["p", "q", "r"]
    rows = [("x", 0, "imgA", 0.4, same, "earth", "kurta", "pants", False, "solid"), ("x", 1, "imgA", 0.2, same, "earth", "kurta", "pants", False, "solid"), ("x", 2, "imgB", 0.3, same, "earth", "kurta", "pants", False, "solid"), ("y", 0, "imgA", 0.1, ["z"], None, None, None, None, None)]
    outfits = spark.createDataFrame(rows, "post_id string, i long, image_id string, area double, presets array<string>, family string, upper string, lower string, single boolean, technique string")
    assert dedup.similar_pairs(outfits).count() == 3
    got = {(r.post_id, r.canonical_index): (r.representative, r.members) for r in dedup.merged(outfits).collect()}
    assert got[("y", 0)] == (0, 1) and got[("x", 0)][0] == 0 and sorted(m for (p, _), (_, m) in got.items() if p == "x") == [1, 2]


def test_frame_quality():
    import pandas as pd

    flat, sharp = bytes([100] * 64), bytes([0, 255] * 32)
    out = next(palette.frame_quality(iter([pd.DataFrame({"frame_id": [1, 2], "pixels": [flat, sharp], "width": [8, 8]})])))
    assert out["blur"][0] == 0 and out["blur"][1] > 0 and out["brightness"][0] == 100
    assert np.ptp(palette.shades_of_gray(np.array([[100.0, 50.0, 100.0]]))) < 1


def test_assignment_in_order():
    from trendloom.operators.ranking import assign

    keys = assign([("a", None), ("a", "x"), ("a", None), ("a", "y"), ("a", "y"), (None, "y"), ("a", None), (None, None), (None, "z"), ("b", "y"), (None, "y")])
    # the first has nothing to follow; one that follows counts for what it follows: a__x leads 2, then a__y with 3
    assert keys == ["a__unknown", "a__x", "a__x", "a__y", "a__y", "a__y", "a__y", "unclassified", "unknown__z", "b__y", "a__y"]


def test_assignment_by_batch(spark):
    from trendloom.operators.ranking import partial_assignment

    rows = [("1", 1, "a", "x", 1), ("2", 2, "a", None, 1), ("3", 3, None, "x", 2), ("4", 4, None, None, 2)]
    got = {r.item_id: r.cluster for r in partial_assignment(spark.createDataFrame(rows, "item_id string, seq long, g string, f string, day int"), "day").collect()}
    assert got == {"1": "a__x", "2": "a__x", "3": "unknown__x", "4": "unclassified"}
    empty = spark.createDataFrame([], "item_id string, seq long, g string, f string, day int")
    assert partial_assignment(empty, "day").count() == 0


def test_first_seen_is_of_all_days(spark):
    from trendloom.operators import emergence

    rows = [(str(i), "newword", f"2024-03-{10 + i % 5:02d}", "instagram", False) for i in range(8)] + [("x", "newword", "2023-01-02", "instagram", False)]
    rows += [(str(i), "kurta", f"2024-03-{10 + i % 5:02d}", "instagram", True) for i in range(8)]
    cleaned = spark.createDataFrame(rows, "item_id string, tag string, d string, source string, known boolean").withColumn("d", F.col("d").cast("date"))
    from datetime import date

    (one,) = emergence.signals(cleaned, date(2024, 3, 17)).collect()
    assert (one.tag, one.spike, one.first_seen) == ("newword", 8, date(2023, 1, 2))
    weeks = {r.week: r.spike for r in emergence.weekly_signals(cleaned).collect()}
    assert weeks == {date(2024, 3, 11): 8}  # a week later its first day is in the base window


def test_scores_with_history(spark):
    from datetime import date

    from trendloom.operators import scoring

    items = spark.createDataFrame(
        [("1", "instagram", "hashtag_haul", 50, 100, 10, 0), ("2", "youtube", None, 0, 5, 1, 1000), ("3", "instagram", "bollywood_decode", 2_000_000, 2_000_000, 0, 0), ("4", "youtube", "bollywood_decode", 0, 1, 0, 10)],
        "item_id string, source string, source_type string, followers long, likes long, comments long, views long",
    )
    fan = spark.createDataFrame([("1", "a__x", 0.5), ("2", "a__x", 2.0), ("3", "b__y", 1.0), ("4", "b__y", 0.0)], "item_id string, cluster string, share double")
    tags = spark.createDataFrame([("1", "#AkshayaTritiya"), ("2", "#other")], "item_id string, tag string")
    day = date(2026, 4, 20)
    acc = {r.cluster: r for r in scoring.accumulators(fan, items, festive=scoring.festival_items(tags, day)).collect()}
    a, b = acc["a__x"], acc["b__y"]
    # 100 / 100 + 2 * 10 / 100 = 1.2, haul 1.5; views 1000 + 5 + 2 = 1007
    assert abs(a.social - 1.2 * 1.5 * 0.5) < 1e-9 and abs(a.views - 2014) < 1e-9 and a.videos == 2 and a.posts == 2.5 and abs(a.festival - 0.75) < 1e-9 and a.presence == 0
    assert abs(a.rate - (0.9 + 2014) / 2.5) < 1e-9 and abs(b.social - 1.0 * 2.0 * 1.1) < 1e-9 and b.presence == 1 and b.views == 0
    assert scoring.festival_items(tags, date(2026, 6, 1)).count() == 0
    history = spark.createDataFrame([("a__x", date(2026, 4, 13), 50.0, 7.0, 30.0, 4.0), ("a__x", date(2026, 4, 12), 1.0, 100.0, 20.0, 2.0), ("a__x", day, 9.0, 9.0, 9.0, 9.0)], "cluster string, d date, score double, posts double, views double, tags double")
    entities = spark.createDataFrame([("a__x", date(2026, 3, 1), "instagram", "old"), ("a__x", date(2025, 1, 1), "instagram", "older")], "cluster string, d date, source string, account string")
    batch = spark.createDataFrame([("a__x", "instagram", "old"), ("a__x", "instagram", "older"), ("a__x", "youtube", "new"), ("a__x", "youtube", None)], "cluster string, source string, account string")
    frame = spark.createDataFrame(list(acc.values()))
    c = {r.cluster: r for r in scoring.contexts(frame, history, entities, batch, day).collect()}["a__x"]
    assert (c.post_growth, c.view_growth, c.velocity, c.new_ig, c.new_yt, c.posts_total, c.base) == (1.5, 0.5, 1.0, 0.5, 1.0, 109.5, 50.0)
    assert scoring.updated(history, history.filter(F.col("d") == F.lit(day)).withColumn("score", F.lit(1.0))).filter(F.col("d") == F.lit(day)).collect()[0].score == 1.0
