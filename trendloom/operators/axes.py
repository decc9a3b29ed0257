"""Axis normalisation of detected groups, and the fan-out of items to two-axis clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import MULT_BOTH
from trendloom.functions import columns as C


def normalized(groups: DataFrame) -> DataFrame:
    """Adds is_ethnic, garment, fabric, technique, styling and weight to detected groups."""
    return (
        groups.withColumn("is_ethnic", C.ethnic(F.col("upper_is_ethnic"), F.col("lower_is_ethnic"), F.col("dress_as_single")))
        .withColumn("garment", F.when(C.is_true(F.col("upper_is_ethnic")), C.lookup(C.norm_word(F.col("upper_word")), vocab.GARMENT_WORDS)))
        .withColumn("fabric", C.lookup(C.norm_word(F.col("fabric_word")), vocab.FABRIC_WORDS))
        .withColumn("technique", C.lookup(C.norm_word(F.col("technique_word")), vocab.TECHNIQUE_WORDS))
        .withColumn("styling", styling())
        .withColumn("weight", C.group_weight(F.col("n_objects"), F.col("area")))
    )


def styling():
    """A single piece stands alone; then a set, the lower piece, the outer layer."""
    lower, outer = C.lookup(C.norm_word(F.col("lower_word")), vocab.STYLING_LOWER), C.lookup(C.norm_word(F.col("outer_word")), vocab.STYLING_OUTER)
    return F.when(C.is_true(F.col("dress_as_single")), "standalone").when(C.is_true(F.col("is_co_ord_set")), "co_ord_set").otherwise(F.coalesce(lower, outer))


def _per_item():
    return Window.partitionBy("item_id")


def item_mass(groups: DataFrame) -> DataFrame:
    """Adds g_total, the log of an item's objects, and g_share, each group's slice of it."""
    total = F.log2(F.sum("n_objects").over(_per_item()) + F.lit(1.0))
    return groups.withColumn("g_total", total).withColumn("g_share", total * C.ratio(F.col("weight"), F.sum("weight").over(_per_item())))


def fanout_normalized(groups: DataFrame) -> DataFrame:
    """item_id, cluster, share: groups without either axis leave before the total; shares of an item sum to 1."""
    known = groups.filter(F.col("is_ethnic") & (F.col("garment").isNotNull() | F.col("fabric").isNotNull()))
    share = C.ratio(F.col("weight"), F.sum("weight").over(_per_item()))
    each = known.select("item_id", C.cluster_key(F.col("garment"), F.col("fabric")).alias("cluster"), share.alias("share"))
    return each.groupBy("item_id", "cluster").agg(F.sum("share").alias("share")).filter("share > 0")


def fanout_mass(groups: DataFrame, drop_before_total: bool = False, merge_same_key: bool = False) -> DataFrame:
    """item_id, canonical_index, cluster, share of mass: one row per group; groups without either axis weigh in the total."""
    known = F.col("garment").isNotNull() | F.col("fabric").isNotNull()
    own = groups.filter(F.col("is_ethnic"))
    own = item_mass(own.filter(known)) if drop_before_total else item_mass(own).filter(known)
    own = own.select("item_id", "canonical_index", C.cluster_key(F.col("garment"), F.col("fabric")).alias("cluster"), F.col("g_share").alias("share"))
    if merge_same_key:
        return own.groupBy("item_id", "cluster").agg(F.min("canonical_index").alias("canonical_index"), F.sum("share").alias("share"))
    return own


def with_growth(fanout: DataFrame, items: DataFrame, factors: DataFrame) -> DataFrame:
    """Multiplies shares by the growth factor of the item's external id, 1 where it has none."""
    tagged = items.select("item_id", "source", "url_tag").join(factors, ["source", "url_tag"], "left").select("item_id", F.coalesce("factor", F.lit(1.0)).alias("factor"))
    return fanout.join(tagged, "item_id").withColumn("share", F.col("share") * F.col("factor")).drop("factor")


def contributions(fanout: DataFrame, items: DataFrame, base_unit: float = 1.0) -> DataFrame:
    """item_id, source, cluster, share, contribution."""
    own = fanout.join(items.select("item_id", "source"), "item_id")
    return own.withColumn("contribution", F.col("share") * C.multiplier(F.col("cluster")) * F.lit(base_unit))


def representatives(contrib: DataFrame) -> DataFrame:
    """cluster, total, share by source, distinct items; clusters without mass go."""
    by = lambda s: F.sum(F.when(F.col("source") == s, F.col("contribution")).otherwise(0.0))
    each = contrib.groupBy("item_id", "cluster").agg(F.sum("contribution").alias("total"), by("instagram").alias("ig"), by("youtube").alias("yt"))  # no items beyond the first shuffle
    out = each.groupBy("cluster").agg(F.sum("total").alias("total"), F.sum("ig").alias("ig"), F.sum("yt").alias("yt"), F.count("item_id").alias("n_items"))
    return out.filter("total > 0").select("cluster", "total", (F.col("ig") / F.col("total")).alias("ig_share"), (F.col("yt") / F.col("total")).alias("yt_share"), "n_items")


def evidence(contrib: DataFrame, k: int) -> DataFrame:
    """The k strongest items of each cluster and source."""
    order = Window.partitionBy("cluster", "source").orderBy(F.desc("contribution"), "item_id")
    return contrib.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def effective_items(contrib: DataFrame) -> DataFrame:
    return contrib.agg((F.sum(F.col("share") * C.multiplier(F.col("cluster"))) / MULT_BOTH).alias("effective_items"))


def cross_fanout(item_dist_g: DataFrame, item_dist_f: DataFrame) -> DataFrame:
    """Products of two distributions inside an item; a missing side is unknown and halves the mass."""
    both = item_dist_g.withColumnsRenamed({"value": "g", "pct": "pg"}).join(item_dist_f.withColumnsRenamed({"value": "f", "pct": "pf"}), "item_id", "full_outer")
    one = F.when(F.col("g").isNull() | F.col("f").isNull(), 0.5).otherwise(1.0)
    share = F.coalesce("pg", F.lit(1.0)) * F.coalesce("pf", F.lit(1.0)) * one
    return both.select("item_id", C.cluster_key(F.col("g"), F.col("f")).alias("cluster"), share.alias("share"))


def stored_shares(items: DataFrame, fallback: DataFrame) -> DataFrame:
    """item_id, cluster, share of items(item_id, shares map): the stored shares, and where there are none those of fallback."""
    has = F.coalesce(F.size("shares"), F.lit(0)) > 0
    stored = items.filter(has).select("item_id", F.explode("shares").alias("cluster", "share"))
    return stored.unionByName(fallback.join(items.filter(~has).select("item_id"), "item_id", "left_semi").select("item_id", "cluster", "share"))


def reassigned(stored: DataFrame, seen: DataFrame) -> DataFrame:
    """item_id, cluster, share: what vision says of an item's clusters where it says anything, else what was stored."""
    return seen.select("item_id", "cluster", "share").unionByName(stored.join(seen.select("item_id").distinct(), "item_id", "left_anti").select("item_id", "cluster", "share"))
