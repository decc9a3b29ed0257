"""Queries over items, tags, captions and urls."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.functions import columns as C
from trendloom.operators import emergence, text
from trendloom.plans.registry import Data, case, query

_SQL_LIST = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
META = f"(tag IN {_SQL_LIST(vocab.META_EXACT)} OR starts_with(tag, 'reels') OR starts_with(tag, 'reel'))"
KNOWN = f"(tag IN {_SQL_LIST(vocab.known_tags())})"
IST = "CAST(posted_at + INTERVAL '330' MINUTE AS DATE)"
CLEAN = f"""t0 AS (SELECT item_id, lower(ltrim(tag, '#')) AS tag FROM tags), cl AS (SELECT t0.item_id, tag, source, {IST} AS d, {KNOWN} AS known FROM t0 JOIN items USING (item_id) WHERE NOT {META} AND tag <> '')"""


@query("C1_normalize", "SELECT item_id, source, likes + 2 * comments + CASE WHEN source = 'youtube' THEN views ELSE 0 END AS raw_count, CASE WHEN source = 'youtube' THEN views ELSE likes END AS growth_metric FROM items")
def _(d: Data):
    yt = F.col("source") == "youtube"
    return d.items.select("item_id", "source", (F.col("likes") + 2 * F.col("comments") + F.when(yt, F.col("views")).otherwise(0)).alias("raw_count"), F.when(yt, F.col("views")).otherwise(F.col("likes")).alias("growth_metric"))


@query("C3_union", "SELECT source, CAST(count(*) AS BIGINT) AS n FROM (SELECT source FROM items WHERE source = 'instagram' UNION ALL SELECT source FROM items WHERE source = 'youtube') GROUP BY source")
def _(d: Data):
    both = d.items.filter("source = 'instagram'").unionByName(d.items.filter("source = 'youtube'"), allowMissingColumns=True)
    return both.groupBy("source").agg(F.count("*").alias("n"))


@query("C4_engagement", "SELECT item_id, round(likes / greatest(coalesce(followers, 0), 100) + 2 * comments / greatest(coalesce(followers, 0), 100), 6) AS rate FROM items")
def _(d: Data):
    return d.items.select("item_id", F.round(C.engagement_rate(F.col("likes"), F.col("comments"), F.col("followers")), 6).alias("rate"))


@query("C5_haul", f"""WITH h AS (SELECT item_id, bool_or(lower(ltrim(tag, '#')) IN {_SQL_LIST(vocab.HAUL_TAGS)}) AS haul FROM tags GROUP BY item_id)
 SELECT item_id, CASE WHEN source_type = 'hashtag_tracking' AND haul THEN 'hashtag_haul' ELSE source_type END AS source_type FROM items JOIN h USING (item_id)""")
def _(d: Data):
    by = d.tags.groupBy("item_id").agg(F.collect_list("tag").alias("tags"))  # one item's tags
    haul = F.arrays_overlap(C.bare_tags(F.col("tags")), F.array(*map(F.lit, vocab.HAUL_TAGS)))
    return d.items.join(by, "item_id").select("item_id", F.when((F.col("source_type") == "hashtag_tracking") & haul, "hashtag_haul").otherwise(F.col("source_type")).alias("source_type"))


@query("C6_tag_token", "SELECT item_id, CAST(pos AS BIGINT) AS pos, concat('#', replace(lower(trim(replace(tag, '#', ' '))), ' ', '')) AS token FROM tags")
def _(d: Data):
    words = F.array(F.replace(F.col("tag"), F.lit("#"), F.lit(" ")))
    return d.tags.select("item_id", F.col("pos").cast("bigint").alias("pos"), F.element_at(C.tag_token(words), 1).alias("token"))


_URL = "CASE page_id % 5 WHEN 0 THEN concat('https://x.com/p/A', CAST(page_id AS STRING), '/?q=1') WHEN 1 THEN concat('https://x.com/reel/B-', CAST(page_id AS STRING)) WHEN 2 THEN concat('https://y.com/watch?a=1&v=C_', CAST(page_id AS STRING)) WHEN 3 THEN concat('https://youtu.be/D', CAST(page_id AS STRING)) ELSE url END"
_SHORT = "coalesce(nullif(regexp_extract(u, '/p/([A-Za-z0-9_-]+)', 1), ''), nullif(regexp_extract(u, '/reel/([A-Za-z0-9_-]+)', 1), ''), nullif(regexp_extract(u, '[?&]v=([A-Za-z0-9_-]+)', 1), ''), nullif(regexp_extract(u, 'youtu\\.be/([A-Za-z0-9_-]+)', 1), ''))"


@query("C7_url_short_tag", f"SELECT page_id, {_SHORT} AS tag FROM (SELECT page_id, {_URL} AS u FROM pages)")
def _(d: Data):
    return d.table("pages").select("page_id", F.expr(_URL).alias("u")).select("page_id", C.short_tag(F.col("u")).alias("tag"))


_MEDIA = "concat(url, CASE page_id % 4 WHEN 0 THEN '/a.MP4?x=1' WHEN 1 THEN '/b.jpg' WHEN 2 THEN '/c.mov' ELSE '/d' END)"


@query("C8_media_split", f"SELECT regexp_matches(lower(split_part({_MEDIA}, '?', 1)), '\\.(mp4|mov|webm|m4v)$') AS video, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY 1")
def _(d: Data):
    return d.table("pages").groupBy(C.is_video_url(F.expr(_MEDIA)).alias("video")).agg(F.count("*").alias("n"))


@query("C16_influencer_tier", "SELECT item_id, CASE WHEN followers >= 1000000 THEN 2.0 WHEN followers >= 100000 THEN 1.5 WHEN followers >= 10000 THEN 1.2 ELSE 1.0 END::DOUBLE AS weight FROM items")
def _(d: Data):
    return d.items.select("item_id", C.influencer_weight(F.col("followers")).alias("weight"))


@query("C17_source_weight", "SELECT source_type, CASE source_type WHEN 'influencer_fixed' THEN 1.0 WHEN 'hashtag_tracking' THEN 1.2 WHEN 'hashtag_haul' THEN 1.5 WHEN 'bollywood_decode' THEN 1.1 ELSE 1.0 END::DOUBLE AS weight, CAST(count(*) AS BIGINT) AS n FROM items GROUP BY ALL")
def _(d: Data):
    return d.items.groupBy("source_type", C.source_type_weight(F.col("source_type")).alias("weight")).agg(F.count("*").alias("n"))


@query("C18_ist_window", f"SELECT CAST({IST} AS VARCHAR) AS d, CAST(count(*) AS BIGINT) AS n FROM items WHERE {IST} BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY 1")
def _(d: Data):
    day = C.ist_date(F.col("posted_at"))
    return d.items.filter(day.between(F.lit(date(1996, 1, 1)), F.lit(date(1996, 12, 31)))).groupBy(day.cast("string").alias("d")).agg(F.count("*").alias("n"))


@query("C20_small_groups", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT item_id) AS BIGINT) AS items FROM groups WHERE area >= 0.10")
def _(d: Data):
    return d.groups.filter("area >= 0.10").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items"))


@query("C21_traditional_filter", "SELECT item_id, bool_or(lower(trim(upper_word)) IN ('kurta', 'saree', 'lehenga') OR coalesce(lower(trim(lower_word)) IN ('salwar', 'palazzo'), FALSE)) AS traditional FROM groups GROUP BY item_id")
def _(d: Data):
    upper, lower = F.lower(F.trim("upper_word")).isin("kurta", "saree", "lehenga"), C.is_true(F.lower(F.trim("lower_word")).isin("salwar", "palazzo"))
    return d.groups.groupBy("item_id").agg(F.bool_or(upper | lower).alias("traditional"))


@query("C24_media_ref", "SELECT item_id, CASE seq % 4 WHEN 0 THEN 'x/a.jpg?s=1' WHEN 1 THEN 'y/clip.mp4' WHEN 2 THEN 'y/Other.MOV?t=2' END AS media_ref FROM items")
def _(d: Data):
    from trendloom.operators import rows

    images, videos = F.array(F.lit("x/b.jpg"), F.lit("x/a.jpg?s=1")), F.array(F.lit("y/clip.mp4"), F.lit("y/Other.MOV?t=2"))
    image_id = F.expr("CASE seq % 4 WHEN 0 THEN 'a.jpg' WHEN 1 THEN 'clip_f12' WHEN 2 THEN 'Other_f3.jpg' ELSE 'none_f1' END")
    return d.items.select("item_id", rows.media_ref(image_id, images, videos).alias("media_ref"))


@query("C25_frame_index", "SELECT page_id, TRY_CAST(nullif(regexp_extract(CASE WHEN page_id % 3 = 0 THEN concat('v_f', CAST(page_id AS STRING), '.jpg') ELSE concat('v', CAST(page_id AS STRING)) END, '_f([0-9]+)(\\.[a-z]+)?$', 1), '') AS INT) AS frame FROM pages")
def _(d: Data):
    name = F.expr("CASE WHEN page_id % 3 = 0 THEN concat('v_f', CAST(page_id AS STRING), '.jpg') ELSE concat('v', CAST(page_id AS STRING)) END")
    return d.table("pages").select("page_id", C.frame_index(name).alias("frame"))



@query("C26_bbox_pixels", f"""WITH b AS (SELECT DISTINCT l_partkey % 10 AS i, l_suppkey % 10 AS j, l_discount AS w, l_tax AS h FROM lineitem),
 p AS (SELECT *, greatest(round_even(i / 10.0 * 640, 0), 0.0) AS x0, greatest(round_even(j / 10.0 * 480, 0), 0.0) AS y0, least(round_even((i / 10.0 + w) * 640, 0), 640.0) AS x1, least(round_even((j / 10.0 + h) * 480, 0), 480.0) AS y1 FROM b),
 q AS (SELECT i, j, w, h, x0, y0, least(greatest(x1, x0 + 32), 640.0) AS x1, least(greatest(y1, y0 + 32), 480.0) AS y1 FROM p)
 SELECT i, j, w, h, CAST(greatest(least(x0, x1 - 32), 0.0) AS BIGINT) AS x0, CAST(greatest(least(y0, y1 - 32), 0.0) AS BIGINT) AS y0, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1 FROM q""")
def _(d: Data):
    b = d.table("lineitem").select((F.col("l_partkey") % 10).alias("i"), (F.col("l_suppkey") % 10).alias("j"), F.col("l_discount").alias("w"), F.col("l_tax").alias("h")).distinct()
    box = C.pixel_box(F.col("i") / 10.0, F.col("j") / 10.0, F.col("w"), F.col("h"), F.lit(640), F.lit(480))
    return b.select("i", "j", "w", "h", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)])


@query("C27_tag_classes", f"WITH t0 AS (SELECT lower(ltrim(tag, '#')) AS tag FROM tags) SELECT CASE WHEN {META} THEN 'meta' WHEN {KNOWN} THEN 'known' ELSE 'unknown' END AS kind, CAST(count(*) AS BIGINT) AS n FROM t0 GROUP BY 1")
def _(d: Data):
    t = F.lower(F.ltrim("tag", F.lit("#")))
    return d.tags.select(t.alias("tag")).groupBy(F.when(text.is_meta(F.col("tag")), "meta").when(text.is_known(F.col("tag")), "known").otherwise("unknown").alias("kind")).agg(F.count("*").alias("n"))


def _rule_sql() -> str:
    parts = []
    for name, (by_tag, by_word) in vocab.ATTRIBUTES.items():
        index = vocab.tag_index(by_tag)
        by = f"arg_min({case('tg', index)}, pos) FILTER (({case('tg', index)}) IS NOT NULL)"
        words = "CASE " + " ".join(f"WHEN contains(txt, '{k}') THEN '{v}'" for v, ks in by_word.items() for k in ks) + " END"
        parts.append((name, by, words))
    tagged = ", ".join(f"{by} AS t_{n}" for n, by, _ in parts)
    out = ", ".join(f"coalesce(t_{n}, {w}) AS {n}" for n, _, w in parts)
    return f"""ta AS (SELECT item_id, {tagged} FROM (SELECT item_id, pos, lower(ltrim(tag, '#')) AS tg FROM tags) GROUP BY item_id),
 ru AS (SELECT item_id, {out} FROM (SELECT item_id, lower(caption) AS txt FROM captions) LEFT JOIN ta USING (item_id))"""


def rules(d: Data):
    by = d.tags.groupBy("item_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tag"))), lambda x: x["tag"]).alias("tags"))  # one item's tags
    return text.rule_attributes(d.captions.join(by, "item_id", "left"))


@query("J14_rule_attributes", f"WITH {_rule_sql()} SELECT item_id, garment, fabric, technique, occasion, styling, {case('technique', vocab.EMBELLISHMENT)} AS embellishment FROM ru")
def _(d: Data):
    return rules(d)


@query("D5_llm_fill", f"""WITH {_rule_sql()}, mo AS (SELECT item_id, CASE WHEN seq % 2 = 0 THEN 'tunic' END AS m_garment, 'silk' AS m_fabric, CASE WHEN seq % 3 = 0 THEN 'solid' END AS m_technique, 'casual' AS m_occasion FROM items WHERE seq % 5 < 3),
 j AS (SELECT *, garment IS NULL OR technique IS NULL OR occasion IS NULL AS asked FROM ru LEFT JOIN mo USING (item_id))
 SELECT item_id, {", ".join(f"CASE WHEN asked THEN coalesce({a}, m_{a}) ELSE {a} END AS {a}, CASE WHEN {a} IS NOT NULL THEN 'rule' WHEN asked AND m_{a} IS NOT NULL THEN 'llm' END AS {a}_method" for a in ("garment", "fabric", "technique", "occasion"))} FROM j""")
def _(d: Data):
    model = d.items.filter("seq % 5 < 3").select("item_id", F.when(F.col("seq") % 2 == 0, "tunic").alias("m_garment"), F.lit("silk").alias("m_fabric"), F.when(F.col("seq") % 3 == 0, "solid").alias("m_technique"), F.lit("casual").alias("m_occasion"))
    return text.llm_fill(rules(d), model, ["garment", "fabric", "technique", "occasion"])


@query("J18_fake_model", f"SELECT item_id, list_extract({vocab.GARMENTS}, CAST((concat('0x', substr(sha256(concat(item_id, '|garment')), 1, 8))::BIGINT) % {len(vocab.GARMENTS)} + 1 AS INT)) AS garment FROM items")
def _(d: Data):
    return d.items.select("item_id", text.fake_model_value(F.col("item_id"), "garment", vocab.GARMENTS).alias("garment"))


@query("D3_brand_mentions", """WITH m AS (SELECT item_id, unnest(regexp_extract_all(caption, '@([A-Za-z0-9_.]{2,})', 1)) AS h, generate_subscripts(regexp_extract_all(caption, '@([A-Za-z0-9_.]{2,})', 1), 1) - 1 AS pos FROM captions)
 SELECT item_id, brand_id, tier, CAST(min(pos) AS INT) AS pos FROM m JOIN brands ON lower(h) = brands.handle GROUP BY ALL""")
def _(d: Data):
    return text.brand_mentions(d.captions, d.brands)


@query("E35_seed_mining", """WITH m AS (SELECT item_id, lower(unnest(regexp_extract_all(caption, '@([A-Za-z0-9_.]{2,})', 1))) AS handle FROM captions),
 s AS (SELECT DISTINCT item_id FROM tags WHERE lower(ltrim(tag, '#')) IN ('kurtaset', 'saree'))
 SELECT handle, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN s.item_id IS NULL THEN 0.0 ELSE 1.0 END), 6) AS with_seed FROM m LEFT JOIN s USING (item_id) GROUP BY handle HAVING count(*) >= 3 AND avg(CASE WHEN s.item_id IS NULL THEN 0.0 ELSE 1.0 END) >= 0.1""")
def _(d: Data):
    seeds = d.tags.filter(F.lower(F.ltrim("tag", F.lit("#"))).isin("kurtaset", "saree")).select("item_id").distinct().withColumn("s", F.lit(1.0))
    agg = text.mentions(d.captions).join(seeds, "item_id", "left").groupBy("handle").agg(F.count("*").alias("n"), F.avg(F.coalesce("s", F.lit(0.0))).alias("w"))
    return agg.filter("n >= 3 AND w >= 0.1").select("handle", "n", F.round("w", 6).alias("with_seed"))


def cleaned(d: Data):
    return emergence.clean_tags(d.tags, d.items)


@query("E23_tag_day_counters", f"WITH {CLEAN} SELECT tag, CAST(d AS VARCHAR) AS d, CAST(count(*) AS BIGINT) AS n FROM cl GROUP BY tag, d")
def _(d: Data):
    return emergence.day_counters(cleaned(d)).withColumn("d", F.col("d").cast("string"))


DENSE = "de AS (SELECT item_id, avg(CASE WHEN known THEN 1.0 ELSE 0.0 END) AS density FROM (SELECT DISTINCT item_id, tag, known FROM cl) GROUP BY item_id)"
POSTS = f"{DENSE}, po AS (SELECT tag, count(*) AS n_posts, count(*) FILTER (density >= 0.5) AS n_fashion FROM (SELECT DISTINCT item_id, tag FROM cl) JOIN de USING (item_id) GROUP BY tag)"


@query("E24_fashion_density", f"WITH {CLEAN}, {DENSE} SELECT item_id, round(density, 6) AS density FROM de")
def _(d: Data):
    return emergence.density(cleaned(d)).withColumn("density", F.round("density", 6))


@query("E23_post_counters", f"WITH {CLEAN}, {POSTS} SELECT tag, CAST(n_posts AS BIGINT) AS n_posts, CAST(n_fashion AS BIGINT) AS n_fashion FROM po")
def _(d: Data):
    return emergence.post_counters(cleaned(d))


@query("F13_emergence", f"""WITH {CLEAN}, {POSTS.replace("density >= 0.5", "density >= 0.34")}, k AS (SELECT tag, count(*) FILTER (d BETWEEN DATE '1997-11-01' AND DATE '1997-11-14') AS spike, count(*) FILTER (d BETWEEN DATE '1997-09-06' AND DATE '1997-10-31') AS base, min(d) AS first_seen FROM cl WHERE NOT known GROUP BY tag)
 SELECT tag, CAST(spike AS BIGINT) AS spike, CAST(first_seen AS VARCHAR) AS first_seen, CAST(n_posts AS BIGINT) AS n_posts FROM k JOIN po USING (tag) WHERE base <= 0 AND spike >= 3 AND n_posts >= 5 AND n_fashion >= 0.5 * n_posts""")
def _(d: Data):
    return emergence.signals(cleaned(d), date(1997, 11, 14), dense=0.34).withColumn("first_seen", F.col("first_seen").cast("string"))


@query("E21_tag_counts", f"WITH {CLEAN} SELECT source, tag, CAST(count(*) AS BIGINT) AS n FROM cl GROUP BY ALL HAVING count(*) > 5")
def _(d: Data):
    return cleaned(d).groupBy("source", "tag").agg(F.count("*").alias("n")).filter("n > 5")


@query("J13_signal_type", """WITH s AS (SELECT item_id, list(DISTINCT CASE WHEN pos % 3 = 0 THEN 'hashtag' WHEN pos % 3 = 1 THEN 'vision_fabric' ELSE 'vision_garment' END) AS ss FROM tags GROUP BY item_id)
 SELECT item_id, CASE WHEN list_contains(ss, 'hashtag') THEN 'hashtag' ELSE list_min(list_filter(ss, lambda x: starts_with(x, 'vision_'))) END AS kind FROM s""")
def _(d: Data):
    kind = F.when(F.col("pos") % 3 == 0, "hashtag").when(F.col("pos") % 3 == 1, "vision_fabric").otherwise("vision_garment")
    return d.tags.groupBy("item_id").agg(F.collect_set(kind).alias("ss")).select("item_id", emergence.signal_type(F.col("ss")).alias("kind"))


@query("D18_annotate_signals", f"""WITH {CLEAN}, u AS (SELECT tag, count(*) AS n FROM cl WHERE NOT known GROUP BY tag), a AS (SELECT tag, n, CASE WHEN contains(tag, 'new1') THEN 'garment' WHEN contains(tag, 'new2') THEN 'fabric' WHEN contains(tag, 'new3') THEN 'technique' ELSE 'other' END AS kind FROM u)
 SELECT tag, CAST(n AS BIGINT) AS n, kind FROM a WHERE kind <> 'other'""")
def _(d: Data):
    u = cleaned(d).filter("NOT known").groupBy("tag").agg(F.count("*").alias("n"))
    words = u.select("tag").withColumn("kind", text.classify_word(F.col("tag")))
    return u.join(words, "tag", "left").filter("kind <> 'other'")


@query("H5_tag_sets", """WITH a AS (SELECT item_id, list_distinct(list(lower(ltrim(tag, '#')))) AS t FROM tags GROUP BY item_id)
 SELECT item_id, CAST(len(list_intersect(t, ['kurtaset', 'saree', 'diwali', 'ootd'])) AS INT) AS shared, CAST(len(t) - len(list_intersect(t, ['kurtaset', 'saree', 'diwali', 'ootd'])) AS INT) AS others FROM a""")
def _(d: Data):
    t = d.tags.groupBy("item_id").agg(F.collect_set(F.lower(F.ltrim("tag", F.lit("#")))).alias("t"))
    some = F.array(*map(F.lit, ["kurtaset", "saree", "diwali", "ootd"]))
    return t.select("item_id", F.size(F.array_intersect("t", some)).alias("shared"), F.size(F.array_except("t", some)).alias("others"))


@query("E38_volume_audit", "SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT handle) AS BIGINT) AS handles, round(avg(len(string_split(caption, ' '))), 6) AS words FROM items JOIN captions USING (item_id) GROUP BY source")
def _(d: Data):
    return d.items.join(d.captions, "item_id").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("handle").alias("handles"), F.round(F.avg(F.size(F.split("caption", " "))), 6).alias("words"))
