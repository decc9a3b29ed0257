"""Connected components: minimum labels over edges, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, c): the smallest node that v reaches, for every node of edges(a, b); equal or repeated edges are harmless."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        once = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("up"))
        new = materialize(once.join(jump, "c").select("v", "old", F.least("c", "up").alias("c")), "labels")
        labels = new.select("v", "c")
        if new.filter("c <> old").isEmpty():
            return labels


def contracted(found: DataFrame, links: DataFrame) -> DataFrame:
    """found(v, c) after further links(a, b): only the components that they join are looked at again."""
    if links.isEmpty():
        return found
    named = lambda end: found.select(F.col("v").alias(end), F.col("c").alias("c" + end))
    ends = links.join(named("a"), "a", "left").join(named("b"), "b", "left")
    edges = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b")
    up = components(edges)
    old = found.join(up.select(F.col("v").alias("c"), F.col("c").alias("up")), "c", "left").select("v", F.coalesce("up", "c").alias("c"))
    return materialize(old.unionByName(up).distinct(), "labels")
