"""Readers, sinks, streams and the driver's contract."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.sources import readers, schemas, sinks
from trendloom.streaming import weekly_stream


def _tsv(path, rows):
    path.write_text("".join("\t".join(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_tsv_batch(spark, tmp_path):
    post = ["d", "1", "h_a", "https://x/p/AA/", "", "2026-04-19T12:00:00Z", 'Kurta "set" #chikankari #été', "c", "1200", "30", "a.jpg,b.jpg,", "2026-04-20 12:00:00", ""]
    bad = [*post[:8], "many", *post[9:]]
    other = [*post[:1], "2", "h_b", *post[3:]]
    posting = _tsv(tmp_path / "p.tsv", [post, bad, other])
    profile = _tsv(tmp_path / "f.tsv", [["d", "1", "h_a", "n", "7", "", "", "", ""], ["d", "1", "h_a", "n", "x", "", "", "", ""], ["d", "2", "h_a", "n", "123456", "", "", "", ""]])
    got = {r.post_id: r for r in readers.tsv_posts(spark, posting, profile).collect()}
    assert set(got) == {"1", "2"} and got["1"].account_followers == 123456 and got["2"].account_followers == 0
    assert got["1"].hashtags == ["#chikankari", "#été"] and got["1"].image_urls == ["a.jpg", "b.jpg"] and '"set"' in got["1"].caption_text
    assert readers.read_tsv(spark, str(tmp_path / "none.tsv"), schemas.TSV_POSTING).count() == 0
    tagged = _tsv(tmp_path / "h.tsv", [["d", "3", "haul", "https://x/p/BB", "i.jpg", "cap", "", "4", "2026-04-20 12:00:00", ""]])
    tag_posts = readers.tsv_hashtag_posts(spark, tagged, placeholder_date=True)
    assert tag_posts.first().likes == 0 and tag_posts.first().post_date == datetime(2026, 4, 15)
    video = ["d", "4", "UC", "https://y/watch?v=VID01", "Chan", "9", "T", "D", "office kurta,test", "t.jpg", "20260304", "5000", "200", "20", "one|two", "", "", ""]
    videos = readers.tsv_videos(spark, _tsv(tmp_path / "v.tsv", [video, [*video[:3], "https://y/none", *video[4:]]]))
    assert videos.count() == 1
    items = {r.source_post_id: r for r in readers.normalize_batch(readers.tsv_posts(spark, posting, profile).unionByName(tag_posts), videos).collect()}
    assert items["VID01"].hashtags == ["#officekurta", "#test"] and items["VID01"].engagement_raw_count == 5240 and items["VID01"].growth_metric == 5000
    assert items["3"].ig_source_type == "hashtag_haul" and items["1"].url_short_tag == "AA" and items["1"].engagement_raw_count == 1260


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"post_id": "1", "likes": 3}, {"post_id": "2", "likes": 4}]')
    assert readers.read_json(spark, str(tmp_path / "a.json"), schemas.RAW_INSTAGRAM).count() == 2
    (tmp_path / "b.json").write_text('[{"post_id": "1", "likes": "many"}]')
    with pytest.raises(Exception):
        readers.read_json(spark, str(tmp_path / "b.json"), schemas.RAW_INSTAGRAM).collect()
    for name, n in (("e1", 1), ("e2", 2)):
        (tmp_path / f"{name}.json").write_text(f'[{{"source_post_id": "x", "growth_metric": {n}}}, {{"source_post_id": "{name}"}}]')
    got = {r.source_post_id: r.growth_metric for r in readers.read_enriched(spark, str(tmp_path / "e*.json"), schemas.NORMALIZED).collect()}
    assert got == {"x": 2, "e1": None, "e2": None}


def test_load_modes(spark):
    df = spark.createDataFrame([(i, datetime(2026, 1, 1 + i)) for i in range(10)], "k long, t timestamp")
    ids = spark.createDataFrame([(3,), (99,)], "k long")
    assert [r.k for r in readers.load(df, "t", "k", ids=ids, page=(0, 5)).collect()] == [3]
    assert [r.k for r in readers.load(df, "t", "k", page=(1, 4)).collect()] == [4, 5, 6, 7]
    assert sorted(r.k for r in readers.load(df, "t", "k", between=("2026-01-02", "2026-01-03")).collect()) == [1, 2]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "item")
    for version in (1, 2):
        sinks.append(spark.createDataFrame([("ig", "a", "t", version, "p"), ("ig", f"b{version}", None, version, None)], "source string, source_post_id string, url_short_tag string, computed_at int, color_palette string"), path)
    assert sorted((r.source_post_id, r.computed_at) for r in sinks.latest_view(spark, path, "item").collect()) == [("a", 2), ("b1", 1), ("b2", 2)]
    assert [r.source_post_id for r in sinks.ethnic_view(spark, path, "item").collect()] == ["a"]
    week = str(tmp_path / "week")
    for rows in ([("w1", 1), ("w2", 2)], [("w2", 3)]):
        sinks.overwrite_weeks(spark.createDataFrame(rows, "week string, n int"), week, "week")
    assert sorted((r.week, r.n) for r in spark.read.parquet(week).collect()) == [("w1", 1), ("w2", 3)]
    key = spark.createDataFrame([("straight_kurta__cotton",)], "k string")
    assert key.select(sinks.representative_id("k")).first()[0] == -4897646237427369181
    assert sinks.dry_run(key, "t") == {"table": "t", "rows": 1, "first": {"k": "straight_kurta__cotton"}}


def test_tag_weeks_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("#Kurta", datetime(2026, 4, 26, 18, 29)), ("kurta", datetime(2026, 4, 26, 18, 30)), ("reels", datetime(2026, 4, 27)), ("kurta", datetime(2026, 5, 20))]
    spark.createDataFrame(rows, "tag string, posted_at timestamp").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("tag string, posted_at timestamp").parquet(src)
    weekly_stream.run_tag_weeks(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(str(r.week_start), r.tag, r.n) for r in got} == {("2026-04-19 18:30:00", "kurta", 1), ("2026-04-26 18:30:00", "kurta", 1)}
    weekly_stream.run_versions(stream, str(tmp_path / "ver"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ver")).count() == 4


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 90 and callable(e.entry)


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).select("id", F.lit(datetime(2026, 1, 1)).alias("t"), F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    plan = readers.load(spark.read.parquet(str(tmp_path / "t")), "t", "id", between=("2026-01-01", "2026-01-02")).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "wide" not in plan.split("ReadSchema")[1].split("\n")[0]
