from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.operators import rows, vision


def _item(spark):
    rep = {"upper_garment_type": "Kurti", "upper_is_ethnic": True, "lower_garment_type": "Jeans", "dress_as_single": False, "fabric": "Cotton", "silhouette": "a_line"}
    member = {"image_id": "a.jpg", "outfit_index": 2, "person_bbox": [0.0, 0.0, 0.5, 0.4], "garment_type": "Kurti", "palette": []}
    frame = {"image_id": "v_f7", "outfit_index": 0, "person_bbox": [0.0, 0.0, 0.2, 0.5], "palette": [{"hex": "#FFFFFF", "share": 1.0, "family": None}]}
    one = {"source": "instagram", "source_post_id": "p", "image_urls": ["x/a.jpg?s=1"], "video_urls": ["y/v.mp4"], "account_followers": 0, "brands": [], "post_palette": [], "canonicals": [{"canonical_index": 0, "representative": rep, "members": [member, frame], "palette": []}, {"canonical_index": 1, "representative": {**rep, "upper_is_ethnic": None}, "members": [frame], "palette": []}]}
    return spark.read.schema(rows.ENRICHED).json(spark.createDataFrame([(json.dumps(one),)], "value string").select("value").rdd.map(lambda r: r.value))


def test_sink_rows(spark):
    items, now = _item(spark), F.lit(1)
    i = rows.item_rows(items, now).first()
    assert (i.brands_mentioned, i.color_palette, i.account_follower_count, i.computed_at) == (None, None, None, 1)
    g = rows.group_rows(items, now).orderBy("canonical_index").collect()
    assert [x.cluster_key for x in g] == ["straight_kurta__cotton", None] and g[0].group_id == "instagram__p__0" and g[0].styling_combo == "with_jeans"
    assert g[0].n_objects == 2 and g[0].mean_area_ratio == pytest.approx(0.15) and g[0].item_contribution_score == pytest.approx(np.log2(3) * np.log2(16))
    o = {x.object_id: x for x in rows.object_rows(items, now).collect()}
    assert o["instagram__p__0__2"].media_ref == "x/a.jpg?s=1" and o["instagram__p__0__0"].media_ref == "y/v.mp4" and o["instagram__p__0__0"].frame_index == 7
    assert o["instagram__p__0__2"].color_palette is None and o["instagram__p__0__0"].color_palette and len(o) == 3
    kept = rows.apply_extraction(items, items.select("source_post_id", F.slice("canonicals", 1, 1).alias("canonicals"), "post_palette")).first()
    assert len(kept.canonicals) == 1
    assert len(rows.apply_extraction(items, items.select("source_post_id", F.slice("canonicals", 1, 0).alias("canonicals"), "post_palette")).first().canonicals) == 2


def test_shares_and_registry(spark):
    df = spark.createDataFrame([("k", None), ("k", {"x": 0.5}), (None, None)], "trend_cluster_key string, trend_cluster_shares map<string,double>")
    assert [r.trend_cluster_shares for r in rows.backfill_shares(df).collect()] == [{"k": 1.0}, {"x": 0.5}, None]
    brands = spark.createDataFrame([("1", "mid", "@A", ["a2"]), ("2", "value", "b", None)], "brand_id string, tier string, handle string, aliases array<string>")
    assert {r.handle for r in rows.checked_registry(brands).collect()} == {"a", "a2", "b"}
    with pytest.raises(ValueError):
        rows.checked_registry(brands.withColumn("handle", F.lit("same"))).count()


def test_vision_arrays():
    assert vision.rgb_lab(np.array([[255, 153, 51]]))[0] == pytest.approx((72.42, 31.0261, 65.7285), abs=2e-3)
    skin, blue = np.array([[200, 150, 120]]), np.array([[0, 0, 255]])
    mix = lambda a, b: np.concatenate([np.repeat(skin, a, 0), np.repeat(blue, b, 0)])
    assert len(vision.drop_skin(mix(100, 0))[0]) == 0 and len(vision.drop_skin(mix(60, 40))[0]) == 100 and len(vision.drop_skin(mix(10, 90))[0]) == 90
    c, p = np.array([[0.0, 0, 0], [1.0, 0, 0], [50.0, 0, 0]]), np.array([[0.5, 0, 0], [2.0, 0, 0]])
    assert vision.match_one_to_one(c, p, 10) == {0: 0, 1: 1} and vision.match_one_to_one(c, p[:0], 10) == {}
    red, green = np.full((4, 4, 3), (255, 0, 0)), np.full((4, 4, 3), (0, 255, 0))
    h = [vision.hue_saturation_histogram(x) for x in (red, red, green)]
    assert vision.histogram_correlation(h[0], h[1]) == pytest.approx(1) and vision.histogram_correlation(h[0], h[2]) < 0.1
    assert vision.select_frames([0.5, 0.9, 0.7], h, 2) == [1, 2] and vision.select_frames([0.0], h[:1], 2) == []
    boxes = np.array([[0, 0, 1, 1], [0.1, 0, 1, 1], [2, 2, 1, 1]], float)
    assert vision.suppress_overlaps(boxes, np.array([0.5, 0.9, 0.1])) == [1, 2]
    assert vision.near_equal_pairs(c) == 1 and [vision.palette_level(*x) for x in ((1, 0, 0, False), (900, 0, 1, False), (900, 0, 0, False))] == ["danger", "warning", "ok"]
