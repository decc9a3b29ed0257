"""Batch readers: JSON, header-less TSV, enriched files and table scans, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from trendloom.functions import columns as C
from trendloom.sources import schemas as S


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array file; one bad record fails the file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Header-less, unquoted; a missing file is an empty one."""
    schema = ", ".join(f"{c} STRING" for c in columns)
    try:
        return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", False).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _csv(c: Column, sep: str = ",") -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), sep), lambda x: x != "")


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)#\w+"), F.lit(0))


def _int(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def _time(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def source_type(entry: Column, handle: Column) -> Column:
    fixed = F.lower(F.ltrim(handle, F.lit("@"))).isin(S.FIXED_HANDLES)
    return F.when(entry == "hashtag", "hashtag_tracking").when(fixed, "bollywood_decode").otherwise("influencer_fixed")


def followers(profiles: DataFrame) -> DataFrame:
    """handle, followers: the last readable row of a handle."""
    own = profiles.withColumn("n", _int("followers")).filter(F.col("n").isNotNull()).withColumn("seq", F.monotonically_increasing_id())
    return own.groupBy("handle").agg(F.max_by("n", "seq").alias("followers"))


def tsv_posts(spark: SparkSession, posting: str, profile: str) -> DataFrame:
    """Posts with their followers; rows that don't parse go."""
    raw = read_tsv(spark, posting, S.TSV_POSTING)
    out = raw.select(
        F.col("id").alias("post_id"), F.lit("influencer_fixed").alias("source_type"), F.col("url").alias("post_url"), F.nullif("handle", F.lit("")).alias("handle"), _csv(F.col("image_paths")).alias("image_urls"),
        F.col("caption").alias("caption_text"), hashtags(F.col("caption")).alias("hashtags"), _int("likes").alias("likes"), _int("comments_count").alias("comments_count"), _time("post_date").alias("post_date"), _time("created_at").alias("collected_at"),
    )
    good = out.filter(F.col("likes").isNotNull() & F.col("comments_count").isNotNull() & F.col("post_date").isNotNull() & F.col("collected_at").isNotNull())
    known = followers(read_tsv(spark, profile, S.TSV_PROFILE))
    return good.join(known, "handle", "left").withColumn("account_followers", F.coalesce("followers", F.lit(0))).drop("followers").withColumnRenamed("handle", "account_handle")


def tsv_hashtag_posts(spark: SparkSession, path: str, placeholder_date: bool = False) -> DataFrame:
    """Hashtag-search rows; they have no post date of their own, and get the stand-in only where asked for."""
    raw = read_tsv(spark, path, S.TSV_HASHTAG)
    date = F.lit(S.HASHTAG_SEARCH_DATE).cast("timestamp") if placeholder_date else F.lit(None).cast("timestamp")
    out = raw.select(
        F.col("id").alias("post_id"), F.lit("hashtag_tracking").alias("source_type"), F.col("url").alias("post_url"), F.lit(None).cast("string").alias("account_handle"), F.filter(F.array("image"), lambda x: x != "").alias("image_urls"),
        F.col("caption").alias("caption_text"), F.when(F.col("tag") != "", F.array(F.concat(F.lit("#"), "tag"))).otherwise(F.array().cast("array<string>")).alias("hashtags"),
        F.coalesce(F.nullif("likes", F.lit("")), F.lit("0")).try_cast("bigint").alias("likes"), F.coalesce(F.nullif("comments", F.lit("")), F.lit("0")).try_cast("bigint").alias("comments_count"), date.alias("post_date"), _time("created_at").alias("collected_at"), F.lit(0).cast("bigint").alias("account_followers"),
    )
    return out.filter(F.col("likes").isNotNull() & F.col("comments_count").isNotNull() & F.col("collected_at").isNotNull())


def tsv_videos(spark: SparkSession, path: str) -> DataFrame:
    raw = read_tsv(spark, path, S.TSV_VIDEO)
    published = F.try_to_timestamp("upload_date", F.lit("yyyyMMdd"))
    out = raw.select(
        C.short_tag(F.col("url")).alias("video_id"), F.col("url").alias("video_url"), "channel", "title", "description", _csv(F.col("tags")).alias("tags"), F.col("thumbnail").alias("thumbnail_url"),
        _int("views").alias("view_count"), _int("likes").alias("like_count"), _int("comments").alias("comment_count"), _csv(F.col("top_comments"), r"\|").alias("top_comments"), published.alias("published_at"), published.alias("collected_at"),
    )
    return out.filter(F.col("video_id").isNotNull() & F.col("view_count").isNotNull() & F.col("like_count").isNotNull() & F.col("comment_count").isNotNull() & F.col("published_at").isNotNull())


def tsv_batch(spark: SparkSession, posting: str, profile: str, hashtag: str, video: str, placeholder_date: bool = False) -> tuple[DataFrame, DataFrame]:
    """(posts of both kinds, videos) of one folder of tab-separated files."""
    posts = tsv_posts(spark, posting, profile)
    return posts.unionByName(tsv_hashtag_posts(spark, hashtag, placeholder_date).select(*posts.columns)), tsv_videos(spark, video)


def _utc(c: str) -> Column:
    return F.to_utc_timestamp(F.col(c).cast("timestamp"), "UTC")


def _urls(videos: bool) -> Column:
    kept = _csv(F.regexp_replace(F.col("download_urls"), r"\s*,\s*", ","))
    return F.filter(kept, lambda u: C.is_video_url(u) if videos else ~C.is_video_url(u))


def olap_posts(table: DataFrame) -> DataFrame:
    """Rows of the post table as raw posts: media split by extension, tags from the text; rows without created_at go."""
    n = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))
    return table.filter(F.col("created_at").isNotNull() & F.col("posting_at").isNotNull()).select(
        F.col("id").alias("post_id"), source_type(F.coalesce(F.nullif("entry", F.lit("")), F.lit("profile")), F.coalesce("user", F.lit(""))).alias("source_type"), F.nullif("url", F.lit("")).alias("post_url"), F.nullif("user", F.lit("")).alias("account_handle"),
        n("follower_count").alias("account_followers"), _urls(False).alias("image_urls"), _urls(True).alias("video_urls"), F.coalesce("content", F.lit("")).alias("caption_text"), hashtags(F.col("content")).alias("hashtags"), n("like_count").alias("likes"), n("comment_count").alias("comments_count"),
        F.lit(None).cast("bigint").alias("saves"), F.col("posting_at").cast("timestamp").alias("post_date"), _utc("created_at").alias("collected_at"),
    )


def olap_videos(table: DataFrame) -> DataFrame:
    """Rows of the video table as raw videos: id from the url, video media only; rows without an id or a date go."""
    n = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))
    trimmed = lambda c, sep: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), sep), F.trim), lambda x: x != "")
    out = table.select(
        C.short_tag(F.col("url")).alias("video_id"), F.col("url").alias("video_url"), F.coalesce("channel", F.lit("")).alias("channel"), n("channel_follower_count").alias("channel_follower_count"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"), trimmed("tags", ",").alias("tags"), F.coalesce("thumbnail_url", F.lit("")).alias("thumbnail_url"), n("view_count").alias("view_count"), n("like_count").alias("like_count"), n("comment_count").alias("comment_count"),
        trimmed("comments", r"\|").alias("top_comments"), F.try_to_timestamp(F.col("upload_date").cast("string"), F.lit("yyyyMMdd")).alias("published_at"), _utc("created_at").alias("collected_at"), _urls(True).alias("video_urls"),
    )
    return out.filter(F.col("video_id").isNotNull() & F.col("published_at").isNotNull() & F.col("collected_at").isNotNull())


def with_urls(items: DataFrame, urls: DataFrame) -> DataFrame:
    """Stored items with the external id of their post's url, where the table urls(source_post_id, url) has it."""
    known = urls.groupBy("source_post_id").agg(F.max("url").alias("_url"))
    return items.join(known, "source_post_id", "left").withColumn("url_short_tag", F.coalesce("url_short_tag", C.short_tag(F.col("_url")))).select(*items.columns)


def renormalized(items: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored items with the normalised columns of fresh(source_post_id, ...) where it has them; all else stays."""
    new = [c for c in fresh.columns if c != "source_post_id"]
    j = items.join(fresh.select("source_post_id", F.struct(*new).alias("_n")), "source_post_id", "left")
    return j.select(*[F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in items.columns])


def normalize_posts(posts: DataFrame) -> DataFrame:
    """Posts as items: text and tags together, growth by likes, a haul tag makes a tracked post a haul."""
    from trendloom import vocab

    haul = F.arrays_overlap(C.bare_tags(F.col("hashtags")), F.array(*map(F.lit, vocab.HAUL_TAGS)))
    kind = F.when((F.col("source_type") == "hashtag_tracking") & haul, "hashtag_haul").otherwise(F.col("source_type"))
    return posts.select(
        F.lit("instagram").alias("source"), F.col("post_id").alias("source_post_id"), C.short_tag(F.col("post_url")).alias("url_short_tag"), F.concat_ws(" ", "caption_text", F.array_join("hashtags", " ")).alias("text_blob"), "hashtags", "image_urls",
        "post_date", "collected_at", C.engagement_rate(F.col("likes"), F.col("comments_count"), F.col("account_followers")).alias("engagement_score"), (F.col("likes") + 2 * F.col("comments_count")).alias("engagement_raw_count"),
        F.col("likes").alias("growth_metric"), "account_followers", kind.alias("ig_source_type"), "account_handle",
    )


def normalize_videos(videos: DataFrame) -> DataFrame:
    n = F.coalesce(F.col("channel_follower_count"), F.lit(0)) if "channel_follower_count" in videos.columns else F.lit(0).cast("bigint")
    tokens = C.tag_token(F.col("tags"))
    return videos.select(
        F.lit("youtube").alias("source"), F.col("video_id").alias("source_post_id"), F.col("video_id").alias("url_short_tag"), F.concat_ws(" ", "title", "description", F.array_join("tags", " ")).alias("text_blob"), tokens.alias("hashtags"), F.array("thumbnail_url").alias("image_urls"),
        F.col("published_at").alias("post_date"), "collected_at", C.engagement_rate(F.col("like_count"), F.col("comment_count"), n).alias("engagement_score"), (F.col("view_count") + F.col("like_count") + 2 * F.col("comment_count")).alias("engagement_raw_count"),
        F.col("view_count").alias("growth_metric"), n.alias("account_followers"), F.lit(None).cast("string").alias("ig_source_type"), F.nullif("channel", F.lit("")).alias("account_handle"),
    )


def normalize_batch(posts: DataFrame, videos: DataFrame) -> DataFrame:
    return normalize_posts(posts).unionByName(normalize_videos(videos), allowMissingColumns=True)


def read_enriched(spark: SparkSession, glob: str, schema: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Files of stored items; of equal ids the last file's record stays, unreadable records go.

    days (first, last) is compared with the first ten characters of post_date, before records meet by id.
    """
    raw = spark.read.schema(f"{schema}, _corrupt STRING").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(glob)
    own = raw.select("*", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_seq")).filter(F.col("_corrupt").isNull())
    if days:
        own = own.filter(F.substring(F.col("post_date").cast("string"), 1, 10).between(*days))
    order = Window.partitionBy("source_post_id").orderBy(F.desc("_file"), F.desc("_seq"))
    return own.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r", "_file", "_seq", "_corrupt")


def load(table: DataFrame, time: str, key: str, *, ids: DataFrame | None = None, page: tuple[int, int] | None = None, between: tuple[str, str] | None = None) -> DataFrame:
    """Ids, else a page (number, size) in order of time and key, else a range of days that reaches the scan."""
    if ids is not None:
        return table.join(ids, key, "left_semi")
    if page is not None:
        return table.orderBy(time, key).offset(page[0] * page[1]).limit(page[1])
    if between is not None:
        kind = dict(table.dtypes)[time]
        lo, hi = (F.lit(x).cast(kind) for x in between)
        return table.filter((F.col(time) >= lo) & (F.col(time) < hi + F.expr("INTERVAL 1 DAY")))
    return table
