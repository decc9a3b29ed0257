"""Queries through files: raw and stored records are written, read by the readers, emitted to the sinks and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import EVIDENCE_TOP_K
from trendloom.functions import columns as C
from trendloom.operators import axes, distributions, emergence, rows
from trendloom.plans.cluster_queries import CONTRIB, FAN, MULT, NORMAL, groups
from trendloom.plans.registry import Data, case, query
from trendloom.plans.text_queries import CLEAN, POSTS, cleaned
from trendloom.sources import emit, readers, scratch, sinks
from trendloom.sources import schemas as S

_TEXT = "concat('Look ', item_id, ' #Kurta #new', CAST(seq % 7 AS STRING))"
_IG, _YT = "source = 'instagram'", "source = 'youtube'"


def _lines(d: Data, df: DataFrame, columns: list[str], tag: str) -> str:
    """A header-less tab-separated folder of the columns; nulls are empty."""
    path = scratch.folder(df.sparkSession, tag)
    df.select(F.concat_ws("\t", *[F.coalesce(F.expr(c).cast("string"), F.lit("")) for c in columns])).write.text(path)
    return path


def _json_arrays(df: DataFrame, tag: str, rows_per_file: int = 2_000) -> str:
    """A folder of files, each one JSON array of about rows_per_file records of df, which has `seq`."""
    path = scratch.folder(df.sparkSession, tag)
    record = F.to_json(F.struct(*[c for c in df.columns if c != "seq"]))
    by = df.select(record.alias("j"), F.expr(f"seq div {rows_per_file}").alias("file")).groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value"))
    by.write.partitionBy("file").text(path)
    return path


def _spark(d: Data):
    return d.items.sparkSession


# --- readers -------------------------------------------------------------------------------------------------------


def _raw_posts(d: Data) -> DataFrame:
    return d.items.filter(_IG).select(
        "seq", F.col("item_id").alias("post_id"), "source_type", F.concat(F.lit("https://x.com/p/"), "url_tag", F.lit("/")).alias("post_url"), F.col("handle").alias("account_handle"), F.col("followers").alias("account_followers"), F.expr(_TEXT).alias("caption_text"),
        F.expr("array('#kurta', concat('#new', CAST(seq % 7 AS STRING)))").alias("hashtags"), "likes", F.col("comments").alias("comments_count"), F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("post_date"), F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("collected_at"),
    )


@query("A2_json_posts", f"SELECT item_id AS post_id, source_type, likes, concat('Look ', item_id, ' #Kurta #new', CAST(seq % 7 AS VARCHAR)) AS caption_text, CAST(posted_at AS VARCHAR) AS post_date, CAST(2 AS INT) AS n_tags FROM items WHERE {_IG}")
def _(d: Data):
    got = readers.read_json(_spark(d), _json_arrays(_raw_posts(d), "posts"), S.RAW_INSTAGRAM)
    return got.select("post_id", "source_type", "likes", "caption_text", F.col("post_date").cast("string").alias("post_date"), F.size("hashtags").alias("n_tags"))


_PROFILE = ["''", "handle", "handle", "''", "CASE WHEN followers % 13 = 0 THEN 'n/a' ELSE CAST(followers AS STRING) END", "''", "''", "''", "''"]


def _posting(d: Data, tag: str = "posting") -> str:
    some = d.items.filter(_IG)
    columns = ["'p'", "item_id", "handle", "concat('https://x.com/p/', url_tag, '/')", "''", "date_format(posted_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", _TEXT, "''", "CASE WHEN seq % 17 = 0 THEN 'many' ELSE CAST(likes AS STRING) END", "comments", "concat('a', item_id, '.jpg,b.jpg')", "date_format(posted_at, 'yyyy-MM-dd HH:mm:ss')", "''"]
    return _lines(d, some, columns, tag)


def _profiles(d: Data) -> str:
    return _lines(d, d.items.select("handle", "followers").distinct(), _PROFILE, "profile")


_FOLLOWERS = "CASE WHEN followers % 13 = 0 THEN 0 ELSE followers END"


@query("A5_tsv_posts", f"SELECT item_id AS post_id, handle AS account_handle, likes, comments AS comments_count, CAST({_FOLLOWERS} AS BIGINT) AS account_followers, CAST(2 AS INT) AS n_images, CAST(2 AS INT) AS n_tags FROM items WHERE {_IG} AND seq % 17 <> 0")
def _(d: Data):
    got = readers.tsv_posts(_spark(d), _posting(d), _profiles(d))
    return got.select("post_id", "account_handle", "likes", "comments_count", "account_followers", F.size("image_urls").alias("n_images"), F.size("hashtags").alias("n_tags"))


@query("A8_followers", "SELECT handle, CAST(max(followers) AS BIGINT) AS followers FROM items WHERE followers % 13 <> 0 GROUP BY handle")
def _(d: Data):
    return readers.followers(readers.read_tsv(_spark(d), _profiles(d), S.TSV_PROFILE))


def _hashtag_rows(d: Data) -> str:
    columns = ["''", "item_id", "CASE WHEN seq % 5 = 0 THEN '' ELSE 'kurta' END", "''", "CASE WHEN seq % 2 = 0 THEN 'i.jpg' ELSE '' END", _TEXT, "CASE WHEN seq % 3 = 0 THEN '' ELSE CAST(likes AS STRING) END", "comments", "date_format(posted_at, 'yyyy-MM-dd HH:mm:ss')", "''"]
    return _lines(d, d.items.filter(_YT), columns, "hashtag")


@query("A6_tsv_hashtags", f"SELECT item_id AS post_id, CASE WHEN seq % 3 = 0 THEN 0 ELSE likes END AS likes, CAST(CASE WHEN seq % 5 = 0 THEN 0 ELSE 1 END AS INT) AS n_tags, CAST(CASE WHEN seq % 2 = 0 THEN 1 ELSE 0 END AS INT) AS n_images FROM items WHERE {_YT}")
def _(d: Data):
    got = readers.tsv_hashtag_posts(_spark(d), _hashtag_rows(d))
    return got.select("post_id", "likes", F.size("hashtags").alias("n_tags"), F.size("image_urls").alias("n_images"))


def _video_rows(d: Data) -> str:
    url = "CASE seq % 6 WHEN 0 THEN 'https://y.com/none' WHEN 1 THEN concat('https://youtu.be/v', item_id) ELSE concat('https://y.com/watch?v=v', item_id) END"
    columns = ["''", "item_id", "''", url, "handle", "''", "concat('Title ', item_id)", "'text'", "'kurta set, silk'", "'t.jpg'", "date_format(post_date, 'yyyyMMdd')", "views", "likes", "comments", "'good|bad'", "''", "''", "''"]
    return _lines(d, d.items.filter(_YT), columns, "video")


@query("A7_tsv_videos", f"SELECT concat('v', item_id) AS video_id, views AS view_count, CAST(post_date AS VARCHAR) AS day, CAST(2 AS INT) AS n_tags, CAST(2 AS INT) AS n_comments FROM items WHERE {_YT} AND seq % 6 <> 0")
def _(d: Data):
    got = readers.tsv_videos(_spark(d), _video_rows(d))
    return got.select("video_id", "view_count", F.to_date("published_at").cast("string").alias("day"), F.size("tags").alias("n_tags"), F.size("top_comments").alias("n_comments"))


@query("A9_tsv_union", f"SELECT source_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(likes) AS BIGINT) AS likes FROM (SELECT 'influencer_fixed' AS source_type, likes FROM items WHERE {_IG} AND seq % 17 <> 0 UNION ALL SELECT 'hashtag_tracking', CASE WHEN seq % 3 = 0 THEN 0 ELSE likes END FROM items WHERE {_YT} UNION ALL SELECT 'video', likes FROM items WHERE {_YT} AND seq % 6 <> 0) GROUP BY source_type")
def _(d: Data):
    posts, videos = readers.tsv_batch(_spark(d), _posting(d), _profiles(d), _hashtag_rows(d), _video_rows(d))
    both = posts.select("source_type", "likes").unionByName(videos.select(F.lit("video").alias("source_type"), F.col("like_count").alias("likes")))
    return both.groupBy("source_type").agg(F.count("*").alias("n"), F.sum("likes").alias("likes"))


@query("A4_missing_file", "SELECT CAST(0 AS BIGINT) AS n")
def _(d: Data):
    return readers.read_tsv(_spark(d), scratch.folder(_spark(d), "none"), S.TSV_PROFILE).agg(F.count("*").alias("n"))


@query("A11_video_page", f"WITH r AS (SELECT item_id, row_number() OVER (ORDER BY post_date, posted_at, item_id) AS r FROM items WHERE {_YT}) SELECT item_id FROM r WHERE r > 100 AND r <= 200")
def _(d: Data):
    own = d.items.filter(_YT).withColumn("at", F.struct("post_date", "posted_at"))
    return readers.load(own, "at", "item_id", page=(1, 100)).select("item_id")


@query("A14_scan_modes", "WITH p AS (SELECT item_id, row_number() OVER (ORDER BY posted_at, item_id) AS r FROM items) SELECT 'ids' AS mode, item_id FROM items WHERE item_id IN (SELECT item_id FROM captions WHERE caption LIKE '%nobody%') UNION ALL SELECT 'page', item_id FROM p WHERE r <= 50 UNION ALL SELECT 'days', item_id FROM items WHERE posted_at >= TIMESTAMP '1997-05-01' AND posted_at < TIMESTAMP '1997-05-04'")
def _(d: Data):
    ids, every = d.captions.filter(F.contains("caption", F.lit("nobody"))).select("item_id"), {"page": (0, 50), "between": ("1997-05-01", "1997-05-03")}
    modes = {"ids": {"ids": ids, **every}, "page": every, "days": {"between": every["between"]}}
    out = None
    for name, how in modes.items():
        one = readers.load(d.items, "posted_at", "item_id", **how).select(F.lit(name).alias("mode"), "item_id")
        out = one if out is None else out.unionByName(one)
    return out


@query("A15_olap_posts", f"""SELECT item_id AS post_id, CASE WHEN seq % 2 = 0 THEN 'hashtag_tracking' WHEN seq % 19 = 0 THEN 'bollywood_decode' ELSE 'influencer_fixed' END AS source_type, CAST(CASE WHEN seq % 3 = 0 THEN 2 ELSE 1 END AS INT) AS n_images, CAST(CASE WHEN seq % 3 = 0 THEN 0 ELSE 1 END AS INT) AS n_videos, followers AS account_followers, CAST(2 AS INT) AS n_tags FROM items WHERE {_IG} AND seq % 23 <> 0""")
def _(d: Data):
    table = d.items.filter(_IG).select(
        F.col("item_id").alias("id"), F.expr("CASE WHEN seq % 2 = 0 THEN 'hashtag' END").alias("entry"), F.expr("CASE WHEN seq % 19 = 0 THEN '@BollyDressDecode' ELSE handle END").alias("user"), F.lit("").alias("url"), F.col("followers").alias("follower_count"),
        F.expr("CASE WHEN seq % 3 = 0 THEN 'a.jpg, b.png ,' ELSE 'a.jpg,v.MP4?x=1' END").alias("download_urls"), F.expr(_TEXT).alias("content"), F.col("likes").alias("like_count"), F.col("comments").alias("comment_count"), F.col("posted_at").alias("posting_at"), F.expr("CASE WHEN seq % 23 <> 0 THEN posted_at END").alias("created_at"),
    )
    return readers.olap_posts(table).select("post_id", "source_type", F.size("image_urls").alias("n_images"), F.size("video_urls").alias("n_videos"), "account_followers", F.size("hashtags").alias("n_tags"))


@query("A16_olap_videos", f"SELECT concat('v', item_id) AS video_id, CAST(post_date AS VARCHAR) AS day, CAST(1 AS INT) AS n_videos, CAST(2 AS INT) AS n_tags, views AS view_count FROM items WHERE {_YT} AND seq % 6 <> 0 AND seq % 23 <> 0")
def _(d: Data):
    table = d.items.filter(_YT).select(
        F.expr("CASE WHEN seq % 6 = 0 THEN 'https://y.com/none' ELSE concat('https://y.com/watch?v=v', item_id) END").alias("url"), F.col("handle").alias("channel"), F.col("followers").alias("channel_follower_count"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("description"), F.lit("kurta, silk ,").alias("tags"),
        F.lit(None).cast("string").alias("thumbnail_url"), F.col("views").alias("view_count"), F.col("likes").alias("like_count"), F.col("comments").alias("comment_count"), F.lit("good | ").alias("comments"), F.expr("CASE WHEN seq % 23 <> 0 THEN date_format(post_date, 'yyyyMMdd') END").alias("upload_date"), F.col("posted_at").alias("created_at"), F.lit("v.mp4,i.jpg").alias("download_urls"),
    )
    return readers.olap_videos(table).select("video_id", F.to_date("published_at").cast("string").alias("day"), F.size("video_urls").alias("n_videos"), F.size("tags").alias("n_tags"), "view_count")


@query("A17_source_type", "SELECT item_id, CASE WHEN seq % 4 = 0 THEN 'hashtag_tracking' WHEN seq % 5 = 0 THEN 'bollywood_decode' ELSE 'influencer_fixed' END AS source_type FROM items")
def _(d: Data):
    entry, handle = F.expr("CASE WHEN seq % 4 = 0 THEN 'hashtag' ELSE 'profile' END"), F.expr("CASE WHEN seq % 5 = 0 THEN '@BollywoodAlmari' ELSE handle END")
    return d.items.select("item_id", readers.source_type(entry, handle).alias("source_type"))


_STORED = "source STRING, source_post_id STRING, post_date STRING, engagement_raw_count BIGINT"


def _stored(d: Data) -> str:
    """Stored items in two folders of arrays, the second with newer records of some."""
    base = d.items.select("seq", "source", F.col("item_id").alias("source_post_id"), F.concat(F.col("post_date").cast("string"), F.lit("T10:00:00Z")).alias("post_date"), F.col("likes").alias("engagement_raw_count"))
    path = scratch.folder(_spark(d), "stored")
    for name, df in (("a", base), ("b", base.filter("seq % 3 = 0").withColumn("engagement_raw_count", F.lit(-1).cast("bigint")))):
        record = F.to_json(F.struct(*[c for c in df.columns if c != "seq"]))
        by = df.groupBy(F.expr("seq div 2000").alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value"))
        by.write.partitionBy("file").text(f"{path}/part={name}")
    return path


@query("A18_enriched", "SELECT item_id AS source_post_id, CAST(CASE WHEN seq % 3 = 0 THEN -1 ELSE likes END AS BIGINT) AS raw FROM items")
def _(d: Data):
    return readers.read_enriched(_spark(d), _stored(d), _STORED).select("source_post_id", F.col("engagement_raw_count").alias("raw"))


@query("A19_date_prefilter", "SELECT item_id AS source_post_id, CAST(CASE WHEN seq % 3 = 0 THEN -1 ELSE likes END AS BIGINT) AS raw FROM items WHERE post_date BETWEEN DATE '1996-02-01' AND DATE '1996-03-15'")
def _(d: Data):
    return readers.read_enriched(_spark(d), _stored(d), _STORED, ("1996-02-01", "1996-03-15")).select("source_post_id", F.col("engagement_raw_count").alias("raw"))


@query("A24_brand_registry", "SELECT handle, brand_id, tier FROM brands UNION SELECT concat('alias', brand_id), brand_id, tier FROM brands WHERE CAST(brand_id AS BIGINT) % 2 = 0")
def _(d: Data):
    alias = F.expr("CASE WHEN CAST(brand_id AS BIGINT) % 2 = 0 THEN array(concat('@Alias', brand_id)) END")
    return rows.checked_registry(d.brands.select("brand_id", "tier", F.concat(F.lit("@"), "handle").alias("handle"), alias.alias("aliases")))


@query("A28_url_lookup", "SELECT item_id AS source_post_id, CASE WHEN url_tag IS NOT NULL THEN url_tag WHEN seq % 2 = 0 THEN concat('N', item_id) END AS url_short_tag FROM items")
def _(d: Data):
    items = d.items.select(F.col("item_id").alias("source_post_id"), F.col("url_tag").alias("url_short_tag"))
    urls = d.items.filter("seq % 2 = 0").select(F.col("item_id").alias("source_post_id"), F.concat(F.lit("https://x.com/reel/N"), "item_id", F.lit("?a=1")).alias("url"))
    return readers.with_urls(items, urls)


@query("A29_renormalise", "SELECT item_id AS source_post_id, CASE WHEN seq % 2 = 0 THEN views ELSE likes END AS raw, handle FROM items")
def _(d: Data):
    items = d.items.select(F.col("item_id").alias("source_post_id"), F.col("likes").alias("raw"), "handle")
    return readers.renormalized(items, d.items.filter("seq % 2 = 0").select(F.col("item_id").alias("source_post_id"), F.col("views").alias("raw")))


@query("C2_normalize_videos", f"SELECT concat('v', item_id) AS source_post_id, views + likes + 2 * comments AS raw, views AS growth, 'Title ' || item_id || ' text kurta set  silk' AS text_blob FROM items WHERE {_YT} AND seq % 6 <> 0")
def _(d: Data):
    return readers.normalize_videos(readers.tsv_videos(_spark(d), _video_rows(d))).select("source_post_id", F.col("engagement_raw_count").alias("raw"), F.col("growth_metric").alias("growth"), "text_blob")


# --- stored rows ---------------------------------------------------------------------------------------------------


@query("D4_apply_extraction", "SELECT item_id AS source_post_id, CAST(CASE WHEN seq % 4 = 0 THEN 2 ELSE 1 END AS INT) AS n_groups FROM items")
def _(d: Data):
    groups_of = lambda n: F.array_repeat(F.struct(F.lit(0).alias("canonical_index")), n)
    items = d.items.select(F.col("item_id").alias("source_post_id"), groups_of(F.lit(1)).alias("canonicals"), F.array(F.lit("x")).alias("post_palette"))
    found = d.items.filter("seq % 2 = 0").select(F.col("item_id").alias("source_post_id"), groups_of(F.expr("CASE WHEN seq % 4 = 0 THEN 2 ELSE 0 END")).alias("canonicals"), F.array(F.lit("y")).alias("post_palette"))
    return rows.apply_extraction(items, found).select("source_post_id", F.size("canonicals").alias("n_groups"))


@query("O6_backfill_shares", f"WITH {FAN}, w AS (SELECT item_id, arg_min(cluster, (-round(share, 9), cluster)) AS cluster FROM fan GROUP BY item_id) SELECT item_id, cluster, CAST(1.0 AS DOUBLE) AS share FROM w")
def _(d: Data):
    from trendloom.operators import ranking

    won = ranking.winner(axes.fanout_normalized(groups(d))).select("item_id", F.col("cluster").alias("trend_cluster_key"), F.lit(None).cast("map<string,double>").alias("trend_cluster_shares"))
    return rows.backfill_shares(won).select("item_id", F.explode("trend_cluster_shares").alias("cluster", "share"))


@query("E5_mean_area", "SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, CAST(n_objects AS BIGINT) AS n_objects, round(CASE WHEN n_objects > 0 THEN area ELSE 0 END, 6) AS mean_area FROM groups")
def _(d: Data):
    g = rows.group_rows(enriched(d), F.lit(0))
    return g.select(F.col("item_source_post_id").alias("item_id"), F.col("canonical_index").cast("bigint").alias("canonical_index"), "n_objects", F.round("mean_area_ratio", 6).alias("mean_area"))


def _collected(d: Data) -> DataFrame:
    """Items with their groups as plain fields, which are all that is shuffled and kept; stored_items makes records of them."""
    fields = ["n_objects", "area", "tax", "upper_word", "upper_is_ethnic", "lower_is_ethnic", "dress_as_single", "silhouette", "fabric_word", "technique_word", "is_co_ord_set", "hex"]
    by = d.groups.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct(F.col("canonical_index").cast("int").alias("canonical_index"), *fields))).alias("g"))  # one item's groups
    return d.items.select("item_id", "source", "url_tag", "posted_at", "likes", "comments", "handle", "followers").join(by, "item_id")


def stored_items(collected: DataFrame) -> DataFrame:
    """Stored items of the bound groups: each group's objects are members of its area."""
    rep = "'upper_garment_type', x.upper_word, 'upper_is_ethnic', x.upper_is_ethnic, 'lower_garment_type', CAST(NULL AS STRING), 'lower_is_ethnic', x.lower_is_ethnic, 'dress_as_single', x.dress_as_single, 'silhouette', x.silhouette, 'fabric', x.fabric_word, 'technique', x.technique_word, 'outer_layer', CAST(NULL AS STRING), 'is_co_ord_set', x.is_co_ord_set"
    palette = "array(named_struct('hex', upper(x.hex), 'share', CAST(1.0 AS DOUBLE), 'family', CAST(NULL AS STRING)))"
    member = f"named_struct('image_id', concat('m', CAST(k AS STRING), '.jpg'), 'outfit_index', CAST(k AS INT), 'person_bbox', array(CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(x.area AS DOUBLE), CAST(1 AS DOUBLE)), 'garment_type', x.upper_word, 'fabric', x.fabric_word, 'technique', x.technique_word, 'silhouette', x.silhouette, 'palette', {palette})"
    some = f"CASE WHEN x.tax > 0.02 THEN {palette} ELSE array() END"
    record = f"named_struct('canonical_index', x.canonical_index, 'representative', named_struct({rep}), 'members', transform(CASE WHEN x.n_objects > 0 THEN sequence(0, x.n_objects - 1) ELSE array() END, k -> {member}), 'palette', {some})"
    return collected.select(
        "source", F.col("item_id").alias("source_post_id"), F.col("url_tag").alias("url_short_tag"), F.array(F.lit("x/m0.jpg?s=1")).alias("image_urls"), F.array().cast("array<string>").alias("video_urls"), F.col("posted_at").alias("post_date"), (F.col("likes") + 2 * F.col("comments")).alias("engagement_raw_count"),
        F.col("handle").alias("account_handle"), F.col("followers").alias("account_followers"), F.lit("office").alias("occasion"), F.array().cast("array<struct<name:string,tier:string>>").alias("brands"), F.array().cast("array<struct<hex:string,share:double,family:string>>").alias("post_palette"), F.expr(f"transform(g, x -> {record})").alias("canonicals"),
    )


def enriched(d: Data) -> DataFrame:
    return stored_items(_collected(d))


# --- sinks ---------------------------------------------------------------------------------------------------------

_T1, _T2 = "2024-05-01 00:00:00", "2024-05-08 00:00:00"


def _at(t: str):
    return F.lit(t).cast("timestamp")


def _emitted(d: Data) -> str:
    """All items at one time, the even ones again a week later, the second batch written twice under its label."""
    root, items = scratch.folder(_spark(d), "sink"), stored_items(scratch.kept(_collected(d), "items"))  # nine tables are written from them
    emit.emit_items(emit.ParquetWriter(root, "one"), items, _at(_T1))
    for _ in range(2):
        emit.emit_items(emit.ParquetWriter(root, "two"), items.filter("CAST(source_post_id AS BIGINT) % 2 = 0"), _at(_T2))
    return root


_SEEN = "(SELECT items.*, CAST(0 AS INT) AS again FROM items UNION ALL SELECT items.*, 1 FROM items WHERE seq % 2 = 0)"


@query("B9_emit_items", f"WITH e AS {_SEEN}, r AS (SELECT *, rank() OVER (PARTITION BY source, coalesce(url_tag, item_id) ORDER BY again DESC) AS r FROM e WHERE item_id IN (SELECT item_id FROM groups)) SELECT item_id AS source_post_id, source, CAST(likes + 2 * comments AS BIGINT) AS engagement_raw, CASE WHEN followers = 0 THEN -1 ELSE followers END AS followers, again FROM r WHERE r = 1")
def _(d: Data):
    got = sinks.latest_view(_spark(d), f"{_emitted(d)}/item", "item")
    return got.select("source_post_id", "source", "engagement_raw", F.coalesce("account_follower_count", F.lit(-1)).alias("followers"), (F.col("computed_at") == _at(_T2)).cast("int").alias("again"))


@query("K2_group_latest", f"""WITH {NORMAL}, e AS {_SEEN}, j AS (SELECT e.item_id, n.canonical_index, again, n.n_objects, rank() OVER (PARTITION BY source, coalesce(url_tag, e.item_id), canonical_index ORDER BY again DESC) AS r, CASE WHEN is_ethnic AND garment IS NOT NULL AND fabric IS NOT NULL THEN concat(garment, '__', fabric) END AS key FROM e JOIN n ON n.item_id = e.item_id)
 SELECT item_id, CAST(canonical_index AS INT) AS canonical_index, again, CAST(n_objects AS BIGINT) AS n_objects, key FROM j WHERE r = 1""")
def _(d: Data):
    got = sinks.latest_view(_spark(d), f"{_emitted(d)}/canonical_group", "canonical_group")
    return got.select(F.col("item_source_post_id").alias("item_id"), "canonical_index", (F.col("computed_at") == _at(_T2)).cast("int").alias("again"), "n_objects", F.col("cluster_key").alias("key"))


@query("K5_ethnic_latest", f"WITH e AS {_SEEN}, j AS (SELECT e.item_id, canonical_index, again, tax, rank() OVER (PARTITION BY source, coalesce(url_tag, e.item_id), canonical_index ORDER BY again DESC) AS r FROM e JOIN groups ON groups.item_id = e.item_id) SELECT item_id, CAST(canonical_index AS INT) AS canonical_index, again FROM j WHERE r = 1 AND tax > 0.02")
def _(d: Data):
    got = sinks.ethnic_view(_spark(d), f"{_emitted(d)}/canonical_group", "canonical_group")
    return got.select(F.col("item_source_post_id").alias("item_id"), "canonical_index", (F.col("computed_at") == _at(_T2)).cast("int").alias("again"))


@query("K3_object_latest", f"""WITH e AS {_SEEN}, m AS (SELECT item_id, canonical_index, area, unnest(range(0, n_objects)) AS k FROM groups), j AS (SELECT e.item_id, canonical_index, k, area, again, rank() OVER (PARTITION BY source, coalesce(url_tag, e.item_id), canonical_index, k ORDER BY again DESC) AS r FROM e JOIN m ON m.item_id = e.item_id)
 SELECT item_id, CAST(canonical_index AS INT) AS canonical_index, CAST(k AS INT) AS member_index, again, round(area, 6) AS area, CASE WHEN k = 0 THEN 'x/m0.jpg?s=1' END AS media_ref FROM j WHERE r = 1""")
def _(d: Data):
    got = sinks.latest_view(_spark(d), f"{_emitted(d)}/canonical_object", "canonical_object")
    return got.select(F.col("item_source_post_id").alias("item_id"), "canonical_index", "member_index", (F.col("computed_at") == _at(_T2)).cast("int").alias("again"), F.round("area_ratio", 6).alias("area"), "media_ref")


_DISTS = {"garment_type_distribution": "garment", "fabric_distribution": "fabric", "silhouette_distribution": "silhouette"}


def _representatives(d: Data, computed_at: str) -> DataFrame:
    from trendloom.plans import weekly
    from trendloom.plans.weekly_queries import _arguments

    own = groups(d)
    fan = scratch.kept(axes.fanout_normalized(own), "fan")
    contrib = scratch.kept(axes.contributions(fan, d.items).withColumn("contribution", F.round("contribution", 9)), "contrib")
    decided, _ = weekly.score_batch(**_arguments(d))
    shared = fan.join(own.select("item_id", *_DISTS.values()), "item_id")
    parts = scratch.kept(distributions.drilldown(shared, list(_DISTS.values())), "parts")  # all distributions in one pass
    dists = {name: parts.filter(F.col("part") == c).select("cluster", "value", "pct") for name, c in _DISTS.items()}
    effective = axes.effective_items(contrib)
    return emit.representative_rows(axes.representatives(contrib), decided, axes.evidence(contrib, EVIDENCE_TOP_K), dists, None, effective, F.lit("2024-04-29").cast("date"), _at(computed_at))


@query("B10_emit_representatives", f"""WITH {CONTRIB}, t AS (SELECT cluster, sum(round(contribution, 9)) AS total FROM c GROUP BY cluster HAVING sum(round(contribution, 9)) > 0), ef AS (SELECT sum(share * {MULT}) / 2.5 AS n FROM c),
 ev AS (SELECT cluster, string_agg(item_id, ',' ORDER BY rank) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY cluster, source ORDER BY round(contribution, 9) DESC, item_id) AS rank FROM c WHERE source = 'instagram') WHERE rank <= 4 GROUP BY cluster)
 SELECT t.cluster, CAST(DATE '2024-04-29' AS VARCHAR) AS week, round(total, 6) AS total, round(ef.n, 4) AS effective, ev.ids FROM t CROSS JOIN ef LEFT JOIN ev USING (cluster)""")
def _(d: Data):
    root, writer = scratch.folder(_spark(d), "sink"), emit.ParquetWriter
    made = scratch.kept(_representatives(d, _T2), "made")  # both batches are written from it
    emit.emit_representatives(writer(root, "one"), made.withColumn("computed_at", _at(_T1)).withColumn("total_item_contribution", F.lit(-1.0)))
    emit.emit_representatives(writer(root, "two"), made)
    got = sinks.latest_view(_spark(d), f"{root}/representative_weekly", "representative_weekly")
    ids = F.array_join(F.from_json("evidence_ig_post_ids", "array<string>"), ",")
    return got.select(F.col("representative_key").alias("cluster"), F.col("week_start_date").cast("string").alias("week"), F.round("total_item_contribution", 6).alias("total"), F.round("effective_item_count", 4).alias("effective"), F.nullif(ids, F.lit("")).alias("ids"))


@query("K7_tag_week_latest", f"""WITH {CLEAN}, {POSTS.replace("density >= 0.5", "density >= 0.3")}, n AS (SELECT tag, count(*) AS n, max(known::INT) AS known FROM cl GROUP BY tag) SELECT tag, CAST(n AS BIGINT) AS n_instances, CAST(n_posts AS BIGINT) AS n_posts, CAST(n_fashion AS BIGINT) AS n_fashion, CAST(known AS INT) AS known FROM n JOIN po USING (tag)""")
def _(d: Data):
    root = scratch.folder(_spark(d), "sink")
    made = scratch.kept(emit.tag_week_rows(cleaned(d), F.lit("2024-04-29").cast("date"), _at(_T1)), "made")  # both batches are written from it
    for label, t in (("one", _T1), ("two", _T2)):
        emit.ParquetWriter(root, label).write_batch("hashtag_weekly", made.withColumn("computed_at", _at(t)))
    got = sinks.latest_view(_spark(d), f"{root}/hashtag_weekly", "hashtag_weekly")
    return got.select("tag", "n_instances", "n_posts", F.col("n_posts_with_known_fashion").alias("n_fashion"), F.col("is_known_mapping").alias("known"))


@query("K6_signal_latest", f"""WITH {CLEAN}, {POSTS.replace("density >= 0.5", "density >= 0.34")}, k AS (SELECT tag, count(*) FILTER (d BETWEEN DATE '1997-11-01' AND DATE '1997-11-14') AS spike, count(*) FILTER (d BETWEEN DATE '1997-09-06' AND DATE '1997-10-31') AS base, min(d) AS first_seen FROM cl WHERE NOT known GROUP BY tag)
 SELECT concat('#', tag) AS tag, CAST(spike AS BIGINT) AS n, CAST(first_seen AS VARCHAR) AS first_seen, '1997-11-10' AS week, 'hashtag' AS signal_type FROM k JOIN po USING (tag) WHERE base <= 0 AND spike >= 3 AND n_posts >= 5 AND n_fashion >= 0.5 * n_posts""")
def _(d: Data):
    from datetime import date

    root, found = scratch.folder(_spark(d), "sink"), emergence.signals(cleaned(d), date(1997, 11, 14), dense=0.34).withColumn("week", F.lit("1997-11-10").cast("date"))
    found = scratch.kept(found, "found")  # both batches are written from it
    for label, t in (("one", _T1), ("two", _T2)):
        emit.emit_signals(emit.ParquetWriter(root, label), found, _at(t))
    got = sinks.latest_view(_spark(d), f"{root}/unknown_signal", "unknown_signal")
    return got.select("tag", F.col("count_recent_window").alias("n"), F.col("first_seen").cast("string").alias("first_seen"), F.col("week_start_date").cast("string").alias("week"), "signal_type")


@query("B4_insert_statements", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length('(' || item_id || ', ' || CAST(likes AS VARCHAR) || ', ' || coalesce('''' || url_tag || '''', 'NULL') || ')')) AS BIGINT) AS chars FROM items")
def _(d: Data):
    made = emit.insert_statements(d.items.select(F.col("item_id").cast("bigint").alias("item_id"), "likes", "url_tag"), "item", 500)
    head = len("INSERT INTO item (item_id, likes, url_tag) VALUES ")
    return made.agg(F.sum("n").alias("n"), F.sum(F.length("statement") - head - 2 * (F.col("n") - 1)).cast("bigint").alias("chars"))


@query("B12_emit_tag_days", f"WITH {CLEAN} SELECT tag, CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week, CAST(count(*) AS BIGINT) AS n FROM cl GROUP BY ALL")
def _(d: Data):
    root = scratch.folder(_spark(d), "weeks")
    weeks = cleaned(d).groupBy("tag", C.monday(F.col("d")).alias("week")).agg(F.count("*").alias("n"))
    for _ in range(2):  # a week that is written again replaces itself
        sinks.overwrite_weeks(weeks.repartition("week"), root, "week")
    return _spark(d).read.parquet(root).select("tag", F.col("week").cast("string").alias("week"), "n")


@query("C13_word_keys", f"SELECT DISTINCT {case('upper_word', vocab.GARMENT_WORDS).replace('CASE upper_word', 'CASE translate(lower(trim(upper_word)), ' + chr(39) + ' -' + chr(39) + ', ' + chr(39) + '__' + chr(39) + ')')} AS garment, upper_word FROM groups")
def _(d: Data):
    return d.lines("groups").select(C.lookup(C.norm_word(F.col("upper_word")), vocab.GARMENT_WORDS).alias("garment"), "upper_word").distinct()
