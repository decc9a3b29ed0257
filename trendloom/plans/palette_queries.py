"""Queries over object palettes: a group is a fabric, its objects are pieces of one garment word, pixels are counted hexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.operators import object_palette
from trendloom.plans.registry import Data, query

#: Picks of each object, and the fixed colours of the preset.
_PICKS = ["#8B0000", "#F5F5DC", "#1E3A5F"]
_FIXED = ["#FFFFFF", "#000000", "#808080"]


def _pixels(d: Data) -> DataFrame:
    return d.lines("groups").select(F.coalesce("fabric_word", F.lit("none")).alias("fabric"), F.concat_ws("/", F.coalesce("fabric_word", F.lit("none")), "upper_word").alias("object"), F.upper("hex").alias("hex"), (F.col("n_objects") + 1).alias("n"), F.lit(1_000_000).alias("frame_area"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("l", "a", "b", "share") if c in df.columns})


@query("L8_dynamic_palette")
def _(d: Data):
    return _rounded(object_palette.dynamic_palettes(_pixels(d).withColumnRenamed("object", "piece"), "piece"))


@query("L11_group_palette")
def _(d: Data):
    picks = _pixels(d).select("object").distinct().withColumn("hexes", F.array(*map(F.lit, _PICKS)))
    return _rounded(object_palette.group_palettes(_pixels(d), picks, "fabric"))


@query("L23_preset")
def _(d: Data):
    return _rounded(object_palette.preset(_pixels(d).select("hex", "n"), fixed=_FIXED))


@query("A25_preset_views")
def _(d: Data):
    """Each colour family of the preset with its names."""
    made = object_palette.preset(_pixels(d).select("hex", "n"), fixed=_FIXED)
    return made.groupBy("family").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names"), F.count("*").alias("n"))


@query("D14_nearest_preset")
def _(d: Data):
    near = object_palette.nearest_preset(d.lines("groups"), object_palette.preset(_pixels(d).select("hex", "n"), fixed=_FIXED))
    return near.withColumn("distance", F.round("distance", 4))
