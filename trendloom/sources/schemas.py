"""Explicit schemas of raw records; readers never infer."""

from __future__ import annotations

RAW_INSTAGRAM = "post_id STRING, source_type STRING, post_url STRING, account_handle STRING, account_followers BIGINT, image_urls ARRAY<STRING>, video_urls ARRAY<STRING>, caption_text STRING, hashtags ARRAY<STRING>, likes BIGINT, comments_count BIGINT, saves BIGINT, post_date TIMESTAMP, collected_at TIMESTAMP"
RAW_YOUTUBE = "video_id STRING, video_url STRING, channel STRING, channel_follower_count BIGINT, title STRING, description STRING, tags ARRAY<STRING>, thumbnail_url STRING, view_count BIGINT, like_count BIGINT, comment_count BIGINT, top_comments ARRAY<STRING>, published_at TIMESTAMP, collected_at TIMESTAMP, video_urls ARRAY<STRING>"
NORMALIZED = "source STRING, source_post_id STRING, url_short_tag STRING, text_blob STRING, hashtags ARRAY<STRING>, image_urls ARRAY<STRING>, video_urls ARRAY<STRING>, post_date TIMESTAMP, collected_at TIMESTAMP, engagement_score DOUBLE, engagement_raw_count BIGINT, growth_metric BIGINT, account_followers BIGINT, ig_source_type STRING, account_handle STRING"
#: Columns of the header-less tab-separated files, by position.
TSV_POSTING = ["part", "id", "handle", "url", "cdn_image", "post_date", "caption", "comments", "likes", "comments_count", "image_paths", "created_at", "updated_at"]
TSV_PROFILE = ["part", "id", "handle", "name", "followers", "c5", "c6", "c7", "c8"]
TSV_HASHTAG = ["part", "id", "tag", "url", "image", "caption", "likes", "comments", "created_at", "updated_at"]
TSV_VIDEO = ["part", "id", "c2", "url", "channel", "subscribers", "title", "description", "tags", "thumbnail", "upload_date", "views", "likes", "comments", "top_comments", "c15", "created_at", "updated_at"]
FIXED_HANDLES = ["bollywoodwomencloset", "celebrity_fashion_decode", "bollywoodalmari", "celebrities_outfit_decode", "bollydressdecode"]
#: Stand-in date of hashtag-search rows, which have none of their own.
HASHTAG_SEARCH_DATE = "2026-04-15 00:00:00"
