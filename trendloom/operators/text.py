"""Attributes, brands and tags from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.functions import columns as C


def rule_attributes(items: DataFrame) -> DataFrame:
    """items(item_id, caption, tags) with five attributes, embellishment and the method of each."""
    text, tags = F.lower(F.col("caption")), C.bare_tags(F.coalesce("tags", F.array().cast("array<string>")))
    out = items.select("item_id", text.alias("text"), tags.alias("tags"))
    for name, (by_tag, by_word) in vocab.ATTRIBUTES.items():
        out = out.withColumn(name, C.first_match(F.col("tags"), F.col("text"), vocab.tag_index(by_tag), by_word))
    return out.withColumn("embellishment", C.lookup(F.col("technique"), vocab.EMBELLISHMENT)).drop("text", "tags")


def llm_fill(rule: DataFrame, model: DataFrame, attributes: list[str]) -> DataFrame:
    """Fills nulls from a model's answers (item_id, m_<attribute>) where any of garment, technique, occasion is missing."""
    j = rule.join(model, "item_id", "left")
    asked = F.col("garment").isNull() | F.col("technique").isNull() | F.col("occasion").isNull()
    out = [F.when(asked, F.coalesce(a, f"m_{a}")).otherwise(F.col(a)).alias(a) for a in attributes]
    method = [F.when(F.col(a).isNotNull(), "rule").when(asked & F.col(f"m_{a}").isNotNull(), "llm").alias(f"{a}_method") for a in attributes]
    return j.select("item_id", *out, *method)


def fake_model_value(key: Column, attribute: str, values: list[str]) -> Column:
    """Deterministic stand-in for a model: a value by the hash of the item and the attribute."""
    n = F.conv(F.substring(F.sha2(F.concat_ws("|", key, F.lit(attribute)), 256), 1, 8), 16, 10).cast("bigint") % len(values)
    return F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))


def mentions(texts: DataFrame) -> DataFrame:
    """item_id, pos, handle of each @mention, lower-case, in order."""
    found = F.regexp_extract_all("caption", F.lit(r"@([A-Za-z0-9_.]{2,})"), F.lit(1))
    return texts.select("item_id", F.posexplode(found).alias("pos", "handle")).withColumn("handle", F.lower("handle"))


def brand_mentions(texts: DataFrame, brands: DataFrame) -> DataFrame:
    """item_id, brand_id, tier, pos: known brands of an item, each at its first mention."""
    known = mentions(texts).join(F.broadcast(brands.select("handle", "brand_id", "tier")), "handle")  # the registry is a parameter of some dozen rows
    return known.groupBy("item_id", "brand_id", "tier").agg(F.min("pos").alias("pos"))


def is_meta(tag: Column) -> Column:
    out = tag.isin(vocab.META_EXACT)
    for p in vocab.META_PREFIXES:
        out = out | tag.startswith(p)
    return out


def is_known(tag: Column) -> Column:
    return tag.isin(vocab.known_tags())


def classify_word(word: Column) -> Column:
    """Deterministic stand-in for a word classifier: ordered substrings."""
    rules = [("kurta", "garment"), ("saree", "garment"), ("suit", "garment"), ("print", "technique"), ("work", "technique"), ("cotton", "fabric"), ("silk", "fabric"), ("new1", "garment"), ("new2", "fabric"), ("new3", "technique")]
    out = F.lit("other")
    for part, kind in reversed(rules):
        out = F.when(F.contains(word, F.lit(part)), kind).otherwise(out)
    return out
