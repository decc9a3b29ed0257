"""Top-k lists and picks; every order is total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.functions import columns as C


def top_posts(mass: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Per cluster the posts of most engagement times share; an item with two groups of one cluster stands twice."""
    own = mass.join(items.select("item_id", "source", "seq", (F.col("likes") + 2 * F.col("comments")).alias("e")), "item_id").filter("source = 'instagram'")
    own = own.withColumn("value", F.round(F.col("e") * F.col("share"), 6))
    order = Window.partitionBy("cluster").orderBy(F.desc("value"), "seq", "canonical_index")
    return own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("cluster", "rank", "item_id", "value")


def top_influencers(mass: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    own = mass.join(items.select("item_id", "source", "handle", (F.col("likes") + 2 * F.col("comments")).alias("e")), "item_id").filter("source = 'instagram'")
    best = own.groupBy("cluster", "handle").agg(F.max(F.round(F.col("e") * F.col("share"), 6)).alias("value"))
    order = Window.partitionBy("cluster").orderBy(F.desc("value"), "handle")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("cluster", "rank", "handle", "value")


def first_videos(fanout: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    own = fanout.select("item_id", "cluster").distinct().join(items.filter("source = 'youtube'").select("item_id", "seq"), "item_id")
    order = Window.partitionBy("cluster").orderBy("seq", "item_id")
    return own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("cluster", "rank", "item_id")


def first_targets(items: DataFrame, k: int) -> DataFrame:
    """Per source the first k items without a garment, in input order."""
    order = Window.partitionBy("source").orderBy("seq", "item_id")
    return items.filter(F.col("garment").isNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def cluster_picks(fanout: DataFrame, items: DataFrame, caps: dict[str, int] | None = None, least: float = 0.10) -> DataFrame:
    """Per cluster and source the items of most raw engagement with enough share, ties in input order; caps by source."""
    caps = caps or {"instagram": 5, "youtube": 1}
    raw = C.raw_engagement(F.col("source"), F.col("likes"), F.col("comments"), F.col("views"))
    own = fanout.filter((F.col("share") >= least) & (F.col("cluster") != "unclassified")).join(items.select("item_id", "source", "seq", raw.alias("e")), "item_id")
    order = Window.partitionBy("cluster", "source").orderBy(F.desc("e"), "seq", "item_id")
    cap = F.lit(0)
    for source, k in caps.items():
        cap = F.when(F.col("source") == source, F.lit(k)).otherwise(cap)
    ranked = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(caps.values()))  # limits before the shuffle
    return ranked.filter(F.col("rank") <= cap).select("cluster", "source", "rank", "item_id")


def winner(fanout: DataFrame) -> DataFrame:
    """item_id, cluster of largest share, ties to the first key."""
    return fanout.groupBy("item_id").agg(F.min_by("cluster", F.struct(-F.round("share", 9), F.col("cluster"))).alias("cluster"))


def rank_change(before: DataFrame, after: DataFrame, k: int) -> DataFrame:
    """cluster, old_rank, new_rank of those that either list has among its first k (lists: cluster, value)."""
    top = lambda x, name: x.orderBy(F.desc("value"), "cluster").limit(k).select("cluster", "value").withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("value"), "cluster"))).drop("value")  # noqa: E731  k rows
    return top(before, "old_rank").join(top(after, "new_rank"), "cluster", "full_outer").select("cluster", "old_rank", "new_rank")


def assign(axes: list[tuple[str | None, str | None]]) -> list[str]:
    """Keys of items in order: known axes are the key, none is unclassified; one takes the key that leads so far among those with it.

    Every item of an exact key counts for it, also one that took it by one axis; ties go to the first key.
    """
    totals: dict[str, int] = {}
    with_axis: dict[tuple[int, str], dict[str, None]] = {}
    out = []
    for g, f in axes:
        if g is None and f is None:
            out.append("unclassified")
            continue
        key = f"{g or 'unknown'}__{f or 'unknown'}"
        if g is None or f is None:
            near = with_axis.get((0, g) if f is None else (1, f))
            if near:
                key = min(near, key=lambda k: (-totals[k], k))
        out.append(key)
        if "unknown" not in key:
            if key not in totals:
                for at, part in enumerate(key.split("__")):
                    with_axis.setdefault((at, part), {})[key] = None
            totals[key] = totals.get(key, 0) + 1
    return out


def partial_assignment(items: DataFrame, batch: str) -> DataFrame:
    """item_id, cluster of every item (item_id, seq, g, f), each batch in its own order and from no totals.

    What an item takes depends on all before it in its batch, so a batch is one task of four small columns.
    """
    own = items.select("item_id", "seq", "g", "f", F.col(batch).alias("batch"))

    def run(pdf):
        pdf = pdf.sort_values(["seq", "item_id"])
        axes = [(g if isinstance(g, str) else None, f if isinstance(f, str) else None) for g, f in zip(pdf["g"], pdf["f"], strict=True)]
        return pdf[["item_id"]].assign(cluster=assign(axes))

    return own.groupBy("batch").applyInPandas(run, items.select("item_id").schema.add("cluster", "string"))
