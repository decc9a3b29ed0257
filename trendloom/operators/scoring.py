"""Cluster scores: share-weighted sums, same-run min-max, direction and stage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.config import SCORING, ScoringConfig
from trendloom.functions import columns as C


def festival_items(tags: DataFrame, day: date, cfg: ScoringConfig = SCORING) -> DataFrame:
    """item_id of the items with a tag of the festival that `day` is in; none outside festivals."""
    return tags.filter(F.lower(F.ltrim("tag", F.lit("#"))).isin(*cfg.active_festival_tags(day))).select("item_id").distinct()


def accumulators(fanout: DataFrame, items: DataFrame, cfg: ScoringConfig = SCORING, festive: DataFrame | None = None) -> DataFrame:
    """Six share-weighted sums by cluster, and the mean engagement; festive(item_id) as festival_items has it.

    Social counts an Instagram item's rate for each follower by the tiers of account and source; views are a video's raw
    engagement; presence is Instagram's only.
    """
    i = items.select("item_id", "source", "source_type", "followers", "likes", "comments", "views")
    j = fanout.filter("share > 0").join(i, "item_id")
    if festive is not None:
        j = j.join(festive.select("item_id", F.lit(1.0).alias("festive")), "item_id", "left")
    ig, yt = F.col("source") == "instagram", F.col("source") == "youtube"
    engagement = C.engagement_rate(F.col("likes"), F.col("comments"), F.col("followers")) * C.influencer_weight(F.col("followers"), cfg) * C.source_type_weight(F.col("source_type"), cfg)
    summed = lambda on, value: F.sum(F.when(on, value * F.col("share")).otherwise(0.0))
    boost = F.lit(cfg.festival_boost) * F.coalesce(F.col("festive"), F.lit(0.0)) if festive is not None else F.lit(0.0)
    acc = j.groupBy("cluster").agg(
        summed(ig, engagement).alias("social"),
        summed(yt, F.lit(1.0)).alias("videos"),
        summed(yt, C.raw_engagement(F.col("source"), F.col("likes"), F.col("comments"), F.col("views")).cast("double")).alias("views"),
        summed(F.lit(True), boost).alias("festival"),
        summed(ig & (F.col("source_type") == "bollywood_decode"), F.lit(1.0)).alias("presence"),
        F.sum("share").alias("posts"),
    )
    return acc.withColumn("rate", (F.col("social") + F.col("views")) / F.when(F.col("posts") > 0, F.col("posts")).otherwise(1.0))


def contexts(acc: DataFrame, history: DataFrame, entities: DataFrame, batch: DataFrame, day: date, cfg: ScoringConfig = SCORING) -> DataFrame:
    """acc with what the history says of each cluster on `day`: growth of posts, views and tags, new accounts, all posts.

    history(cluster, d, score, posts, views, tags) holds earlier days, entities(cluster, d, source, account) who posted on
    them, batch(cluster, source, account) who posts today, a row for each post.
    """
    ago = F.datediff(F.lit(day), F.col("d"))
    within = lambda c, lo, hi: F.sum(F.when(ago.between(lo, hi), F.col(c)).otherwise(0.0))
    w = cfg.window_days
    past = history.filter(F.col("d") < F.lit(day)).groupBy("cluster").agg(
        (within("posts", 1, w) / w).alias("mean_posts"), within("views", 1, 7).alias("v1"), within("views", 8, 14).alias("v2"), within("tags", 1, 7).alias("t1"), within("tags", 8, 14).alias("t2"),
        F.sum("posts").alias("posts_before"), F.max(F.when(ago == 7, F.col("score"))).alias("base"),
    )
    seen = entities.filter(ago.between(1, cfg.new_entity_days)).select("cluster", "source", "account").distinct().withColumn("old", F.lit(1))
    new = batch.filter(F.col("account").isNotNull()).join(seen, ["cluster", "source", "account"], "left").groupBy("cluster").agg(
        *[F.coalesce(F.avg(F.when(F.col("source") == s, F.col("old").isNull().cast("double"))), F.lit(0.0)).alias(n) for s, n in (("instagram", "new_ig"), ("youtube", "new_yt"))]
    )
    j = acc.join(past, "cluster", "left").join(new, "cluster", "left")
    return j.select(
        *acc.columns, C.ratio(F.col("v1") - F.col("v2"), F.col("v2")).alias("view_growth"), C.ratio(F.col("posts") - F.col("mean_posts"), F.col("mean_posts")).alias("post_growth"),
        C.ratio(F.col("t1") - F.col("t2"), F.col("t2")).alias("velocity"), F.coalesce("new_ig", F.lit(0.0)).alias("new_ig"), F.coalesce("new_yt", F.lit(0.0)).alias("new_yt"),
        (F.coalesce("posts_before", F.lit(0.0)) + F.col("posts")).alias("posts_total"), "base",
    )


def decisions(scored: DataFrame, context: DataFrame, day: date, first_day: date, cfg: ScoringConfig = SCORING) -> DataFrame:
    """Scores with change over a week, direction (flat without a baseline), stage and maturity of the collection."""
    j = scored.join(context.select("cluster", "posts_total", "rate", F.col("views").cast("long").alias("video_views"), "base"), "cluster")
    change = F.when(F.col("base").isNotNull(), C.ratio((F.col("score") - F.col("base")) * 100, F.col("base"))).otherwise(0.0)
    j = j.withColumn("change_pct", change)
    return j.withColumn("direction", F.when(F.col("base").isNull(), "flat").otherwise(C.direction(F.col("change_pct"), cfg))).withColumn(
        "stage", C.lifecycle(F.col("score"), F.col("posts_total"), F.lit("flat"), cfg)
    ).withColumn("maturity", C.data_maturity(F.lit((day - first_day).days + 1), cfg)).withColumn("name", C.display_name(F.col("cluster"))).drop("base")


def history_row(scored: DataFrame, acc: DataFrame, tags: DataFrame, day: date) -> DataFrame:
    """The day's rows of the history: cluster, d, score, posts, views, tags; tags(cluster, tags) counts the batch's tags."""
    return scored.select("cluster", "score").join(acc.select("cluster", "posts", "views"), "cluster").join(tags, "cluster", "left").select("cluster", F.lit(day).alias("d"), "score", "posts", "views", F.coalesce("tags", F.lit(0)).cast("double").alias("tags"))


def updated(history: DataFrame, today: DataFrame) -> DataFrame:
    """The history with the day's rows; a day that is scored again replaces itself."""
    same = today.select("cluster", "d")
    return history.join(same, ["cluster", "d"], "left_anti").unionByName(today.select(*history.columns))


def raw_factors(acc: DataFrame, cfg: ScoringConfig = SCORING) -> DataFrame:
    """cluster, posts and four raw factors; acc may bring the columns of contexts."""
    has = lambda c: F.coalesce(F.col(c), F.lit(0.0)) if c in acc.columns else F.lit(0.0)
    count, views, growth = cfg.video_weights
    video = F.when((F.col("videos") > 0) | (F.col("views") > 0), count * F.col("videos") + views * F.col("views") + growth * F.greatest(has("view_growth"), F.lit(0.0))).otherwise(0.0)
    festival, presence = cfg.cultural_weights
    a, b, c, d = cfg.momentum_weights
    momentum = a * has("post_growth") + b * has("velocity") + c * has("new_ig") + d * has("new_yt")
    return acc.select("cluster", "posts", F.col("social").alias("f_social"), video.alias("f_youtube"), (festival * has("festival") + presence * F.col("presence")).alias("f_cultural"), momentum.alias("f_momentum"))


def scores(raw: DataFrame, cfg: ScoringConfig = SCORING) -> DataFrame:
    """Each factor scaled by the run's own minimum and maximum (equal values give 0), their sum, one aggregate for all."""
    weights = {"social": cfg.weight_social, "youtube": cfg.weight_youtube, "cultural": cfg.weight_cultural, "momentum": cfg.weight_momentum}
    limits = raw.agg(*[f(f"f_{k}").alias(f"{n}_{k}") for k in weights for n, f in (("lo", F.min), ("hi", F.max))])  # one row
    j = raw.crossJoin(F.broadcast(limits))
    for k, w in weights.items():
        j = j.withColumn(k, w * C.ratio(F.col(f"f_{k}") - F.col(f"lo_{k}"), F.col(f"hi_{k}") - F.col(f"lo_{k}")))
    total = F.col("social") + F.col("youtube") + F.col("cultural") + F.col("momentum")
    return j.select("cluster", "posts", *weights, total.alias("score"))


def display_boost(scored: DataFrame, factor: float = 2.0, cap: float = 100.0) -> DataFrame:
    """Optional: the total times factor, capped, its parts in proportion."""
    total = F.least(F.col("score") * factor, F.lit(cap))
    parts = ["social", "youtube", "cultural", "momentum"]
    by = C.ratio(total, F.col("score"))
    return scored.select("cluster", total.alias("score"), *[(F.col(p) * by).alias(p) for p in parts])
