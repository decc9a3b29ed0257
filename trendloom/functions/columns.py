"""Pure column expressions: all of them stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.config import MULT_BOTH, MULT_ONE, SCORING, UNKNOWN, ScoringConfig


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The dictionary's value; null where the key is missing."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.coalesce(c, F.lit("")))


def norm_word(c: Column) -> Column:
    return F.translate(F.lower(F.trim(c)), " -", "__")


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def ratio(n: Column, d: Column, otherwise: float = 0.0) -> Column:
    """n / d, and `otherwise` where d is null or not positive."""
    return F.when(d > 0, n / d).otherwise(F.lit(otherwise))


def ethnic(upper: Column, lower: Column, single: Column) -> Column:
    """A single piece counts by its upper flag, two pieces by either; an unknown flag is no."""
    return F.when(is_true(single), is_true(upper)).otherwise(is_true(upper) | is_true(lower))


def group_weight(n: Column, area: Column) -> Column:
    return F.when(n > 0, F.log2(n + F.lit(1.0)) * F.log2(100 * F.greatest(area, F.lit(0.0)) + 1)).otherwise(F.lit(0.0))


def raw_engagement(source: Column, likes: Column, comments: Column, views: Column) -> Column:
    """Likes and twice the comments, and a video's views."""
    return likes + 2 * comments + F.when(source == "youtube", F.coalesce(views, F.lit(0))).otherwise(F.lit(0))


def object_weight(area: Column) -> Column:
    return F.log2(100 * F.greatest(area, F.lit(0.0)) + 1)


def cluster_key(g: Column, f: Column) -> Column:
    return F.concat_ws("__", F.coalesce(g, F.lit(UNKNOWN)), F.coalesce(f, F.lit(UNKNOWN)))


def multiplier(key: Column) -> Column:
    known = F.size(F.filter(F.split(key, "__"), lambda x: x != UNKNOWN))
    return F.when(known == 2, F.lit(MULT_BOTH)).when(known == 1, F.lit(MULT_ONE)).otherwise(F.lit(0.0))


def display_name(key: Column) -> Column:
    return F.array_join(F.transform(F.split(key, "__"), lambda x: F.replace(x, F.lit("_"), F.lit(" "))), " / ")


def engagement_rate(likes: Column, comments: Column, followers: Column) -> Column:
    base = F.greatest(F.coalesce(followers, F.lit(0)), F.lit(100))
    return likes / base + 2 * comments / base


def influencer_weight(followers: Column, cfg: ScoringConfig = SCORING) -> Column:
    out = F.lit(cfg.influencer_base)
    for least, weight in reversed(cfg.influencer_tiers):
        out = F.when(followers >= least, F.lit(weight)).otherwise(out)
    return out


def source_type_weight(kind: Column, cfg: ScoringConfig = SCORING) -> Column:
    out = F.lit(1.0)
    for name, weight in cfg.source_type_weights.items():
        out = F.when(kind == name, F.lit(weight)).otherwise(out)
    return out


def bare_tags(tags: Column) -> Column:
    """Lower-case tags without their leading signs."""
    return F.transform(tags, lambda t: F.lower(F.ltrim(t, F.lit("#"))))


def tag_token(words: Column) -> Column:
    """Video tags as hashtag tokens; empty ones go."""
    squeezed = F.transform(words, lambda w: F.replace(F.lower(F.trim(w)), F.lit(" "), F.lit("")))
    return F.transform(F.filter(squeezed, lambda w: w != ""), lambda w: F.concat(F.lit("#"), w))


def short_tag(url: Column) -> Column:
    """External id: post, reel, watch or short link, the first that fits."""
    patterns = [r"/p/([A-Za-z0-9_-]+)", r"/reel/([A-Za-z0-9_-]+)", r"[?&]v=([A-Za-z0-9_-]+)", r"youtu\.be/([A-Za-z0-9_-]+)"]
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in patterns])


VIDEO_SUFFIX = r"\.(mp4|mov|webm|m4v)$"


def is_video_url(url: Column) -> Column:
    return F.lower(F.split_part(url, F.lit("?"), F.lit(1))).rlike(VIDEO_SUFFIX)


def basename(path: Column) -> Column:
    return F.element_at(F.split(F.split_part(path, F.lit("?"), F.lit(1)), "/"), -1)



def ist_date(ts: Column) -> Column:
    """Business day: UTC plus five and a half hours."""
    return F.to_date(ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE"))


def monday(d: Column) -> Column:
    return F.date_sub(d, F.weekday(d))


def iso_week(d: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def direction(pct: Column, cfg: ScoringConfig = SCORING) -> Column:
    t = cfg.direction_threshold_pct
    return F.when(pct >= t, "up").when(pct <= -t, "down").otherwise("flat")


def lifecycle(score: Column, posts: Column, trend: Column, cfg: ScoringConfig = SCORING) -> Column:
    return (
        F.when(posts < cfg.early_post_count, "early")
        .when(score < cfg.early_below, "early")
        .when(trend == "down", "decline")
        .when(score >= cfg.growth_until, "maturity")
        .otherwise("growth")
    )


def data_maturity(days: Column, cfg: ScoringConfig = SCORING) -> Column:
    few, enough = cfg.maturity_days
    return F.when(days < few, "bootstrap").when(days < enough, "partial").otherwise("full")


def pixel_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, least: int = 32) -> list[Column]:
    """Normalised box to clipped pixel corners, half-even rounding, each side at least `least` where the image allows it."""
    x0, y0 = F.greatest(F.bround(x * width), F.lit(0.0)), F.greatest(F.bround(y * height), F.lit(0.0))
    x1, y1 = F.least(F.bround((x + w) * width), width.cast("double")), F.least(F.bround((y + h) * height), height.cast("double"))
    x1, y1 = F.least(F.greatest(x1, x0 + least), width.cast("double")), F.least(F.greatest(y1, y0 + least), height.cast("double"))
    x0, y0 = F.greatest(F.least(x0, x1 - least), F.lit(0.0)), F.greatest(F.least(y0, y1 - least), F.lit(0.0))
    return [c.cast("bigint") for c in (x0, y0, x1, y1)]


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x, y, w, h)."""
    iw = F.greatest(F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    ih = F.greatest(F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    return ratio(iw * ih, a[2] * a[3] + b[2] * b[3] - iw * ih)


def first_match(tags: Column, text: Column, tag_table: dict[str, str], keywords: dict[str, list[str]]) -> Column:
    """The value of the first known tag, else of the first keyword (in order of declaration) that the text holds."""
    by_tag = F.try_element_at(F.filter(F.transform(tags, lambda t: lookup(t, tag_table)), lambda v: v.isNotNull()), F.lit(1))
    by_word = F.coalesce(*[F.when(F.contains(text, F.lit(k)), F.lit(v)) for v, ks in keywords.items() for k in ks])
    return F.coalesce(by_tag, by_word)


def frame_index(image_id: Column) -> Column:
    """The number after `_f` at the end of an image name; null without one."""
    return F.regexp_extract(image_id, r"_f([0-9]+)(\.[a-z]+)?$", 1).try_cast("int")
