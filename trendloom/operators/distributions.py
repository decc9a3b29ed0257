"""Distributions over attribute values, in long form: no rows stand for an empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.config import TEXT_WEIGHTS
from trendloom.functions import columns as C
from trendloom.operators.axes import item_mass


def item_distribution(groups: DataFrame, attribute: str, text: DataFrame | None = None) -> DataFrame:
    """item_id, value, pct from group slices, and from text evidence (item_id, value, method) where given."""
    mass = item_mass(groups).filter(F.col(attribute).isNotNull()).select("item_id", F.col(attribute).alias("value"), F.col("g_share").alias("w"))
    if text is not None:
        weight = F.lit(0.0)
        for method, w in TEXT_WEIGHTS.items():
            weight = F.when(F.col("method") == method, F.lit(w)).otherwise(weight)
        mass = mass.unionByName(text.filter(F.col("value").isNotNull()).select("item_id", "value", weight.alias("w")))
    by = mass.groupBy("item_id", "value").agg(F.sum("w").alias("w")).filter("w > 0")
    return by.select("item_id", "value", (F.col("w") / F.sum("w").over(Window.partitionBy("item_id"))).alias("pct"))


def share_weighted(rows: DataFrame, by: str, value: str, share: str) -> DataFrame:
    """by, value, pct: values weighed by share, nulls left out."""
    agg = rows.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.sum(share).alias("w"))
    return agg.select(by, F.col(value).alias("value"), C.ratio(F.col("w"), F.sum("w").over(Window.partitionBy(by))).alias("pct"))


def drilldown(mass: DataFrame, parts: list[str]) -> DataFrame:
    """cluster, part, value, pct: each of the parts' values weighed by share, all parts in one pass."""
    each = F.explode(F.filter(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).cast("string").alias("value")) for p in parts]), lambda x: x["value"].isNotNull())).alias("x")
    agg = mass.select("cluster", "share", each).groupBy("cluster", "x.part", "x.value").agg(F.sum("share").alias("w"))
    return agg.select("cluster", "part", "value", C.ratio(F.col("w"), F.sum("w").over(Window.partitionBy("cluster", "part"))).alias("pct"))


def brand_distribution(fanout: DataFrame, item_brands: DataFrame, least: float = 0.05, k: int = 5) -> DataFrame:
    """cluster, rank, name, pct: brands of an item divide its share, rare brands go, five stay and are normalised again."""
    named = item_brands.select("item_id", "name").distinct()
    n = F.count("*").over(Window.partitionBy("item_id")).cast("double")
    named = named.withColumn("w", 1 / (F.log2(n + 1) * n))
    raw = fanout.groupBy("item_id", "cluster").agg(F.sum("share").alias("share")).join(named, "item_id").groupBy("cluster", "name").agg(F.sum(F.col("share") * F.col("w")).alias("w"))
    per = Window.partitionBy("cluster")
    first = raw.withColumn("p", C.ratio(F.col("w"), F.sum("w").over(per))).filter(F.col("p") >= least)
    rank = F.row_number().over(per.orderBy(F.desc(F.round("p", 9)), "name"))
    top = first.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.select("cluster", "rank", "name", C.ratio(F.col("p"), F.sum("p").over(per)).alias("pct"))


def weighted_average(dists: DataFrame, by: str) -> DataFrame:
    """by, value, pct from (by, value, pct, weight): the weighted mean of distributions over the weights of all their periods."""
    weights = dists.select(by, "period", "weight").distinct().groupBy(by).agg(F.sum("weight").alias("total"))
    agg = dists.groupBy(by, "value").agg(F.sum(F.col("pct") * F.col("weight")).alias("w"))
    return agg.join(weights, by).select(by, "value", C.ratio(F.col("w"), F.col("total")).alias("pct"))


def majority(rows: DataFrame, group: list[str], value: str, area: str, order: list[str]) -> DataFrame:
    """Most frequent value of a group, ties by mean area, then by vocabulary order."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(value))
    agg = rows.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"), F.round(F.avg(area), 9).alias("a"))
    best = Window.partitionBy(*group).orderBy(F.desc("n"), F.desc("a"), place, value)
    return agg.withColumn("r", F.row_number().over(best)).filter("r = 1").select(*group, F.col(value).alias("value"), "n")


def with_rest(dists: DataFrame, by: str, name: str = "etc") -> DataFrame:
    """by, value, pct with a row for what the shares of a group lack to 1."""
    rest = dists.groupBy(by).agg((1 - F.sum("pct")).alias("pct")).filter("pct > 1e-9").select(by, F.lit(name).alias("value"), "pct")
    return dists.select(by, "value", "pct").unionByName(rest)
