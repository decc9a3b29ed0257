"""Equal outfits inside one post: pair similarity, and unions that may not join one image with itself."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.config import DEDUP, DedupConfig
from trendloom.functions import columns as C


def similar_pairs(outfits: DataFrame, cfg: DedupConfig = DEDUP) -> DataFrame:
    """post_id, i, j, similarity of the pairs i < j of one post at or above the threshold.

    outfits: post_id, i, image_id, area, presets (array), family, upper, lower, single, technique.
    """
    a = outfits.select("post_id", *[F.col(c).alias(f"{c}_a") for c in outfits.columns if c != "post_id"])
    b = outfits.select("post_id", *[F.col(c).alias(f"{c}_b") for c in outfits.columns if c != "post_id"])
    eq = lambda c: C.is_true(F.col(f"{c}_a") == F.col(f"{c}_b"))
    pieces = eq("upper") & (C.is_true(F.col("single_a")) | C.is_true(F.col("single_b")) | eq("lower"))
    part = lambda c, w: F.when(c, F.lit(w)).otherwise(0.0)
    total = part(F.size(F.array_intersect("presets_a", "presets_b")) >= 2, cfg.preset_weight) + part(eq("family"), cfg.family_weight) + part(pieces, cfg.garment_weight) + part(eq("technique"), cfg.technique_weight)
    j = a.join(b, "post_id").filter("i_a < i_b").withColumn("similarity", F.round(total, 6))
    return j.filter(F.col("similarity") >= cfg.threshold).select("post_id", F.col("i_a").alias("i"), F.col("i_b").alias("j"), "similarity")


def merged(outfits: DataFrame, cfg: DedupConfig = DEDUP) -> DataFrame:
    """post_id, canonical_index, representative, members: unions by falling similarity, with the image veto."""
    pairs = similar_pairs(outfits, cfg).groupBy("post_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "i", "j"))).alias("pairs"))  # one post's outfits
    nodes = outfits.groupBy("post_id").agg(F.sort_array(F.collect_list(F.struct("i", "image_id", "area"))).alias("nodes"))
    j = nodes.join(pairs, "post_id", "left")

    def union(batches):
        for pdf in batches:
            out = []
            for post, own, links in zip(pdf["post_id"], pdf["nodes"], pdf["pairs"], strict=True):
                group = {n["i"]: [n["i"]] for n in own}
                image = {n["i"]: n["image_id"] for n in own}
                for p in links if links is not None else ():
                    x, y = group[p["i"]], group[p["j"]]
                    if x is y or {image[k] for k in x} & {image[k] for k in y}:
                        continue
                    y.extend(x)
                    for k in x:
                        group[k] = y
                area = {n["i"]: n["area"] for n in own}
                key = lambda k: (-area[k], image[k], k)
                sets = {id(g): g for g in group.values()}
                for index, g in enumerate(sorted(sets.values(), key=lambda g: key(min(g, key=key)))):
                    out.append((post, index, min(g, key=key), len(g)))
            yield pd.DataFrame(out, columns=["post_id", "canonical_index", "representative", "members"])

    return j.mapInPandas(union, outfits.select("post_id").schema.add("canonical_index", "integer").add("representative", "long").add("members", "integer"))
