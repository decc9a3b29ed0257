"""Tags that emerge: counters by tag and day, and windows around an anchor day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions import columns as C
from trendloom.operators.text import is_known, is_meta

SPIKE_DAYS, BASE_DAYS = 14, 56
MIN_SPIKE, MIN_POSTS, MIN_FASHION = 3, 5, 0.5


def clean_tags(tags: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, tag, d, source, known: bare tags without the platform's own noise, on the business day."""
    own = tags.select("item_id", F.lower(F.ltrim("tag", F.lit("#"))).alias("tag")).filter(~is_meta(F.col("tag")) & (F.col("tag") != ""))
    when = items.select("item_id", "source", C.ist_date(F.col("posted_at")).alias("d"))
    return own.join(when, "item_id").withColumn("known", is_known(F.col("tag")))


def day_counters(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("tag", "d").agg(F.count("*").alias("n"))


def density(cleaned: DataFrame) -> DataFrame:
    """item_id, density: share of an item's different tags that are known."""
    return cleaned.select("item_id", "tag", "known").distinct().groupBy("item_id").agg(F.avg(F.col("known").cast("double")).alias("density"))


def with_vision(cleaned: DataFrame, words: DataFrame, items: DataFrame) -> DataFrame:
    """cleaned with the vision words(item_id, tag) that an item's hashtags lack, once each, and `seen` for items with any."""
    own = words.select("item_id", F.lower("tag").alias("tag")).filter(~is_meta(F.col("tag")) & (F.col("tag") != "")).distinct()
    new = own.join(cleaned.select("item_id", "tag").distinct(), ["item_id", "tag"], "left_anti")
    when = items.select("item_id", "source", C.ist_date(F.col("posted_at")).alias("d"))
    both = cleaned.unionByName(new.join(when, "item_id").withColumn("known", is_known(F.col("tag"))).select(*cleaned.columns))
    return both.join(own.select("item_id").distinct().withColumn("seen", F.lit(True)), "item_id", "left")


def post_counters(cleaned: DataFrame, least: float = 0.5) -> DataFrame:
    """tag, n_posts, n_fashion: posts of a tag, and those whose tag density is at least `least` or that vision has seen."""
    seen = F.coalesce(F.bool_or("seen"), F.lit(False)) if "seen" in cleaned.columns else F.lit(False)
    own = cleaned.filter("item_id IS NOT NULL").groupBy("item_id").agg(F.collect_set(F.struct("tag", "known")).alias("t"), seen.alias("vision"))  # one item's tags
    known = F.filter("t", lambda x: x["known"].isNotNull())
    density = F.size(F.filter(known, lambda x: x["known"])) / F.nullif(F.size(known), F.lit(0))
    each = own.select(F.explode(F.array_distinct(F.transform("t", lambda x: x["tag"]))).alias("tag"), (F.col("vision") & F.lit(least <= 1.0) | (density >= least)).alias("fashion"))
    return each.groupBy("tag").agg(F.count("*").alias("n_posts"), F.count(F.when(F.col("fashion"), 1)).alias("n_fashion"))


def signals(cleaned: DataFrame, anchor: date, dense: float = 0.5) -> DataFrame:
    """tag, spike, first_seen (of all its days), n_posts: unknown tags that are new, frequent enough and in the right company."""
    spike0, base0 = anchor - timedelta(days=SPIKE_DAYS - 1), anchor - timedelta(days=SPIKE_DAYS + BASE_DAYS - 1)
    within = lambda a, b: F.col("d").between(F.lit(a), F.lit(b))
    counted = cleaned.filter(~F.col("known")).groupBy("tag").agg(
        F.count(F.when(within(spike0, anchor), 1)).alias("spike"), F.count(F.when(within(base0, spike0 - timedelta(days=1)), 1)).alias("base"), F.min("d").alias("first_seen")
    )
    hot = counted.filter((F.col("base") <= 0) & (F.col("spike") >= MIN_SPIKE)).join(post_counters(cleaned, dense), "tag")
    return hot.filter((F.col("n_posts") >= MIN_POSTS) & (F.col("n_fashion") >= MIN_FASHION * F.col("n_posts"))).select("tag", "spike", "first_seen", "n_posts")


def signal_type(sources):
    """Hashtag first, otherwise the alphabetically first vision kind."""
    return F.when(F.array_contains(sources, "hashtag"), "hashtag").otherwise(F.array_min(F.filter(sources, lambda s: s.startswith("vision_"))))


def weekly_signals(cleaned: DataFrame, dense: float = 0.5) -> DataFrame:
    """week (Monday), tag, spike, first_seen, n_posts of every week that a tag can be a signal of, each judged at its Sunday.

    A tag's days are summed once; its weeks are those whose spike window holds one of its days, so a tag has at most three
    candidate weeks for each of its days, whatever the length of the history.
    """
    days = cleaned.filter(~F.col("known")).groupBy("tag", "d").agg(F.count("*").alias("n"))
    first = days.groupBy("tag").agg(F.min("d").alias("first_seen"))
    weeks = F.sequence(C.monday(F.col("d")), C.monday(F.date_add("d", SPIKE_DAYS - 1)), F.expr("INTERVAL 7 DAYS"))
    at = days.select("tag", F.explode(weeks).alias("week")).distinct().withColumn("anchor", F.date_add("week", 6))
    ago = F.datediff("anchor", "d")
    both = at.join(days, "tag").filter(ago.between(0, SPIKE_DAYS + BASE_DAYS - 1))
    summed = both.groupBy("tag", "week").agg(F.sum(F.when(ago < SPIKE_DAYS, F.col("n")).otherwise(0)).alias("spike"), F.sum(F.when(ago >= SPIKE_DAYS, F.col("n")).otherwise(0)).alias("base"))
    hot = summed.filter((F.col("base") <= 0) & (F.col("spike") >= MIN_SPIKE)).join(first, "tag").join(post_counters(cleaned, dense), "tag")
    return hot.filter((F.col("n_posts") >= MIN_POSTS) & (F.col("n_fashion") >= MIN_FASHION * F.col("n_posts"))).select("week", "tag", "spike", "first_seen", "n_posts")
