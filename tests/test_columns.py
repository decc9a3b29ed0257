"""Row-local expressions against known values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import DedupConfig, ScoringConfig
from trendloom.functions import color
from trendloom.functions import columns as C


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_engagement(spark):
    r = one(spark, C.engagement_rate(F.lit(10), F.lit(1), F.lit(0)), C.engagement_rate(F.lit(210), F.lit(3), F.lit(5400)))
    assert r.c0 == pytest.approx(0.12) and r.c1 == pytest.approx(0.04)


def test_group_weight(spark):
    r = one(spark, C.group_weight(F.lit(3), F.lit(0.5)), C.group_weight(F.lit(0), F.lit(0.5)), C.group_weight(F.lit(3), F.lit(0.0)))
    assert r.c0 == pytest.approx(11.344851, abs=1e-6) and r.c1 == 0 and r.c2 == 0


def test_ethnic_flags(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    r = one(spark, C.ethnic(n, t, t), C.ethnic(n, t, f), C.ethnic(t, n, t), C.ethnic(f, n, n))
    assert list(r) == [False, True, True, False]


def test_tiers_and_types(spark):
    r = one(spark, *[C.influencer_weight(F.lit(x)) for x in (9_999, 10_000, 100_000, 1_000_000)], C.source_type_weight(F.lit("hashtag_haul")), C.source_type_weight(F.lit(None).cast("string")))
    assert list(r) == [1.0, 1.2, 1.5, 2.0, 1.5, 1.0]


def test_urls(spark):
    urls = ["https://www.instagram.com/p/FIX_a-1/", "https://x/reel/R1?x=1", "https://y/watch?a=b&v=TEST", "https://youtu.be/Q", "https://z/"]
    r = one(spark, *[C.short_tag(F.lit(u)) for u in urls], C.is_video_url(F.lit("a/B.MP4?x=.jpg")), C.is_video_url(F.lit("a/b.jpg?x=.mp4")), C.frame_index(F.lit("v_f12.jpg")), C.frame_index(F.lit("v")), C.basename(F.lit("a/b/c.jpg?q=/d")))
    assert list(r) == ["FIX_a-1", "R1", "TEST", "Q", None, True, False, 12, None, "c.jpg"]


def test_days_and_weeks(spark):
    t = lambda x: F.lit(x).cast("timestamp")
    d = lambda x: F.lit(x).cast("date")
    r = one(spark, C.ist_date(t("2026-01-01 18:29:59")).cast("string"), C.ist_date(t("2026-01-01 18:30:00")).cast("string"), C.iso_week(d("2026-04-27")), C.iso_week(d("2025-12-29")), C.monday(d("2026-04-30")).cast("string"))
    assert list(r) == ["2026-01-01", "2026-01-02", "2026-W18", "2026-W01", "2026-04-27"]


def test_words(spark):
    r = one(spark, C.lookup(C.norm_word(F.lit(" A-line Kurta")), vocab.GARMENT_WORDS), C.lookup(F.lit(None).cast("string"), vocab.GARMENT_WORDS), C.display_name(F.lit("a_line_kurta__silk")), C.multiplier(F.lit("unknown__silk")), C.multiplier(F.lit("a__b")), C.multiplier(F.lit("unknown__unknown")))
    assert list(r) == ["a_line_kurta", None, "a line kurta / silk", 1.0, 2.5, 0.0]


def test_stages(spark):
    r = one(spark, C.direction(F.lit(5.0)), C.direction(F.lit(-5.0)), C.direction(F.lit(4.9)), *[C.lifecycle(F.lit(s), F.lit(p), F.lit(t)) for s, p, t in ((90.0, 9.0, "flat"), (29.9, 50.0, "up"), (50.0, 50.0, "down"), (65.0, 50.0, "flat"), (50.0, 50.0, "flat"))], C.data_maturity(F.lit(2)), C.data_maturity(F.lit(7)))
    assert list(r) == ["up", "down", "flat", "early", "early", "decline", "maturity", "growth", "bootstrap", "full"]


def test_boxes(spark):
    r = one(spark, *C.pixel_box(F.lit(0.99), F.lit(0.5), F.lit(0.5), F.lit(0.001), F.lit(640), F.lit(480)), C.iou([F.lit(x) for x in (0.0, 0.0, 1.0, 1.0)], [F.lit(x) for x in (0.5, 0.0, 1.0, 1.0)]))
    assert list(r)[:4] == [608, 240, 640, 272] and r.c4 == pytest.approx(1 / 3)


@pytest.mark.parametrize(("hx", "lab"), [("#FF9933", (72.4200, 31.0261, 65.7285)), ("B8D4C3", (82.4950, -12.5933, 5.2745)), ("#80030B", (25.8030, 47.6795, 33.8145))])
def test_lab(spark, hx, lab):
    r = one(spark, *color.rgb_lab(*color.hex_channels(F.lit(hx))))
    assert list(r) == pytest.approx(lab, abs=2e-3)


def test_families(spark):
    cases = {(90, 0, 0): "white_on_white", (55, -2, -1): "neutral", (78, 15, 5): "pastel", (35, 16, -44): "jewel", (60, 45, 55): "bright", (45, 28, 30): "earth"}
    r = one(spark, *[color.family(*[F.lit(float(x)) for x in lab]) for lab in cases], color.delta_e([F.lit(0.0)] * 3, [F.lit(0.0), F.lit(3.0), F.lit(4.0)]))
    assert list(r)[:-1] == list(cases.values()) and list(r)[-1] == 5.0


def test_rules_first_match(spark):
    tags, text = F.array(F.lit("none"), F.lit("saree"), F.lit("kurtaset")), F.lit("an anarkali with a band collar")
    r = one(spark, C.first_match(tags, text, vocab.tag_index(vocab.GARMENT_TAGS), vocab.GARMENT_KEYWORDS), C.first_match(F.array(F.lit("x")), text, vocab.tag_index(vocab.GARMENT_TAGS), vocab.GARMENT_KEYWORDS))
    assert list(r) == ["casual_saree", "anarkali"]


def test_config_checks():
    with pytest.raises(ValueError):
        ScoringConfig(weight_social=50.0)
    with pytest.raises(ValueError):
        DedupConfig(preset_weight=0.9)
