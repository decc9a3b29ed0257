"""Further queries: raw factors, festival boost, weekly replay of tags, contributors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendloom.config import SCORING
from trendloom.functions import columns as C
from trendloom.operators import axes, emergence, scoring
from trendloom.plans.cluster_queries import ACC, CONTRIB, FAN, FESTIVE_DAY, acc, contributions, groups
from trendloom.plans.registry import Data, query
from trendloom.plans.text_queries import CLEAN, KNOWN, POSTS, cleaned


@query("J2_video_raw", f"WITH {ACC} SELECT cluster, round(CASE WHEN videos > 0 OR views > 0 THEN 0.3 * videos + 0.4 * views ELSE 0 END, 4) AS video FROM acc")
def _(d: Data):
    return scoring.raw_factors(acc(d)).select("cluster", F.round("f_youtube", 4).alias("video"))


@query("J3_cultural_raw", f"WITH {ACC} SELECT cluster, round(0.6 * festival + 0.4 * presence, 6) AS cultural FROM acc")
def _(d: Data):
    return scoring.raw_factors(acc(d)).select("cluster", F.round("f_cultural", 6).alias("cultural"))


@query("C19_festival_items", "SELECT DISTINCT item_id FROM tags WHERE lower(ltrim(tag, '#')) IN ('akshayatritiya', 'akshayatritiya2026', 'goldethnic')")
def _(d: Data):
    return scoring.festival_items(d.tags, FESTIVE_DAY)


@query("J4_momentum_raw", """WITH h AS (SELECT cluster, date_diff('day', DATE '1970-01-01', d) AS n, d, posts, tags FROM history),
 w AS (SELECT cluster, d, posts, coalesce(sum(posts) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) / 7 AS mean, coalesce(sum(tags) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS t1,
  coalesce(sum(tags) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 14 PRECEDING AND 8 PRECEDING), 0) AS t2 FROM h)
 SELECT cluster, round(0.4 * CASE WHEN mean > 0 THEN (posts - mean) / mean ELSE 0 END + 0.3 * CASE WHEN t2 > 0 THEN (t1 - t2) / t2 ELSE 0 END, 6) AS momentum FROM w WHERE d = DATE '2024-01-25'""")
def _(d: Data):
    from trendloom.operators import history

    a, b, _, _ = SCORING.momentum_weights
    day = history.day_features(d.history).filter("d = DATE '2024-01-25'")
    return day.select("cluster", F.round(a * F.col("post_growth") + b * F.col("velocity"), 6).alias("momentum"))


@query("F14_weekly_emergence", f"""WITH {CLEAN}, {POSTS.replace("density >= 0.5", "density >= 0.34")}, td AS (SELECT tag, d, count(*) AS n FROM cl WHERE NOT known GROUP BY ALL), fs AS (SELECT tag, min(d) AS first_seen FROM td GROUP BY tag),
 wk AS (SELECT DISTINCT tag, CAST(unnest(generate_series(date_trunc('week', d), date_trunc('week', d + 13), INTERVAL 7 DAY)) AS DATE) AS week FROM td),
 sm AS (SELECT wk.tag, week, coalesce(sum(n) FILTER (date_diff('day', d, week + 6) < 14), 0) AS spike, coalesce(sum(n) FILTER (date_diff('day', d, week + 6) >= 14), 0) AS base FROM wk JOIN td ON td.tag = wk.tag AND date_diff('day', d, week + 6) BETWEEN 0 AND 69 GROUP BY ALL)
 SELECT CAST(week AS VARCHAR) AS week, tag, CAST(spike AS BIGINT) AS spike, CAST(first_seen AS VARCHAR) AS first_seen, CAST(n_posts AS BIGINT) AS n_posts FROM sm JOIN fs USING (tag) JOIN po USING (tag) WHERE base <= 0 AND spike >= 3 AND n_posts >= 5 AND n_fashion >= 0.5 * n_posts""")
def _(d: Data):
    out = emergence.weekly_signals(cleaned(d), dense=0.34)
    return out.withColumn("first_seen", F.col("first_seen").cast("string")).withColumn("week", F.col("week").cast("string"))


@query("G8_contributors", f"""WITH {CONTRIB}, r AS (SELECT cluster, item_id, share, row_number() OVER (PARTITION BY cluster ORDER BY round(share, 9) DESC, item_id) AS rank FROM c) SELECT cluster, CAST(rank AS INT) AS rank, item_id, round(share, 6) AS share FROM r WHERE rank <= 20""")
def _(d: Data):
    order = Window.partitionBy("cluster").orderBy(F.desc(F.round("share", 9)), "item_id")
    ranked = contributions(d).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 20)
    return ranked.select("cluster", "rank", "item_id", F.round("share", 6).alias("share"))


@query("O4_resolved_axes", f"WITH {FAN} SELECT item_id, CAST(max((split_part(cluster, '__', 1) <> 'unknown')::INT + (split_part(cluster, '__', 2) <> 'unknown')::INT) AS INT) AS axes FROM fan GROUP BY item_id")
def _(d: Data):
    known = F.size(F.filter(F.split("cluster", "__"), lambda x: x != "unknown"))
    return axes.fanout_normalized(groups(d)).groupBy("item_id").agg(F.max(known).alias("axes"))


@query("E11_multiplier", f"WITH {FAN} SELECT DISTINCT cluster, (CASE (split_part(cluster, '__', 1) <> 'unknown')::INT + (split_part(cluster, '__', 2) <> 'unknown')::INT WHEN 2 THEN 2.5 WHEN 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS multiplier FROM fan")
def _(d: Data):
    return axes.fanout_normalized(groups(d)).select("cluster", C.multiplier(F.col("cluster")).alias("multiplier")).distinct()


_VISION = "vw AS (SELECT DISTINCT item_id, translate(lower(trim(fabric_word)), ' -', '__') AS tag FROM groups WHERE fabric_word IS NOT NULL)"


@query("D17_vision_tags", f"""WITH {CLEAN}, {_VISION}, nw AS (SELECT item_id, tag FROM vw EXCEPT SELECT item_id, tag FROM cl), al AS (SELECT item_id, tag, known FROM cl UNION ALL SELECT item_id, tag, {KNOWN} FROM nw JOIN items USING (item_id)),
 de AS (SELECT item_id, avg(CASE WHEN known THEN 1.0 ELSE 0.0 END) AS density FROM (SELECT DISTINCT item_id, tag, known FROM al) GROUP BY item_id), it AS (SELECT tag, count(*) AS n_instances FROM al GROUP BY tag)
 SELECT u.tag, CAST(any_value(n_instances) AS BIGINT) AS n_instances, CAST(count(*) AS BIGINT) AS n_posts, CAST(count(*) FILTER (density >= 0.9 OR u.item_id IN (SELECT item_id FROM vw)) AS BIGINT) AS n_fashion FROM (SELECT DISTINCT item_id, tag FROM al) u JOIN de USING (item_id) JOIN it ON it.tag = u.tag GROUP BY u.tag""")
def _(d: Data):
    words = d.groups.filter("fabric_word IS NOT NULL").select("item_id", C.norm_word(F.col("fabric_word")).alias("tag"))
    both = emergence.with_vision(cleaned(d), words, d.items)
    n = both.groupBy("tag").agg(F.count("*").alias("n_instances"))
    return emergence.post_counters(both, 0.9).join(n, "tag").select("tag", "n_instances", "n_posts", "n_fashion")


@query("O5_stored_shares", f"WITH {FAN} SELECT item_id, 'stored__key' AS cluster, CAST(0.5 AS DOUBLE) AS share FROM items WHERE seq % 2 = 0 UNION ALL SELECT item_id, cluster, round(share, 6) FROM fan WHERE item_id IN (SELECT item_id FROM items WHERE seq % 2 <> 0)")
def _(d: Data):
    items = d.items.select("item_id", F.expr("CASE WHEN seq % 2 = 0 THEN map('stored__key', CAST(0.5 AS DOUBLE)) WHEN seq % 3 = 0 THEN map() END").cast("map<string,double>").alias("shares"))
    return axes.stored_shares(items, axes.fanout_normalized(groups(d))).withColumn("share", F.round("share", 6))


@query("J16_reassign", f"WITH {FAN} SELECT item_id, cluster, round(share, 6) AS share FROM fan UNION ALL SELECT item_id, 'text__only', CAST(1.0 AS DOUBLE) FROM items WHERE item_id NOT IN (SELECT item_id FROM fan)")
def _(d: Data):
    stored = d.items.select("item_id", F.lit("text__only").alias("cluster"), F.lit(1.0).alias("share"))
    return axes.reassigned(stored, axes.fanout_normalized(groups(d))).withColumn("share", F.round("share", 6))


@query("P4_rest_bucket", f"""WITH {FAN}, s AS (SELECT cluster, source_type AS value, sum(share) AS w FROM fan JOIN items USING (item_id) GROUP BY ALL), p AS (SELECT cluster, value, w / sum(w) OVER (PARTITION BY cluster) AS pct FROM s), kp AS (SELECT * FROM p WHERE pct >= 0.3)
 SELECT cluster, value, round(pct, 6) AS pct FROM kp UNION ALL SELECT cluster, 'etc', round(1 - sum(pct), 6) FROM kp GROUP BY cluster HAVING 1 - sum(pct) > 1e-9""")
def _(d: Data):
    from trendloom.operators import distributions

    own = axes.fanout_normalized(groups(d)).join(d.items.select("item_id", "source_type"), "item_id")
    large = distributions.share_weighted(own, "cluster", "source_type", "share").filter("pct >= 0.3")
    return distributions.with_rest(large, "cluster").withColumn("pct", F.round("pct", 6))


@query("P5_normalised_score", f"WITH {CONTRIB}, t AS (SELECT cluster, sum(contribution) AS total FROM c GROUP BY cluster HAVING sum(contribution) > 0), en AS (SELECT sum(share * (CASE (split_part(cluster, '__', 1) <> 'unknown')::INT + (split_part(cluster, '__', 2) <> 'unknown')::INT WHEN 2 THEN 2.5 WHEN 1 THEN 1.0 ELSE 0.0 END)) / 2.5 AS n FROM c) SELECT cluster, round(total / en.n, 8) AS score FROM t, en")
def _(d: Data):
    c = contributions(d)
    j = axes.representatives(c).crossJoin(F.broadcast(axes.effective_items(c)))  # one row
    return j.select("cluster", F.round(C.ratio(F.col("total"), F.col("effective_items")), 8).alias("score"))


@query("P7_week_momentum", "SELECT a.cluster, CAST(a.week AS VARCHAR) AS week, round(CASE WHEN b.score > 0 THEN (a.score - b.score) / b.score END, 6) AS momentum FROM weekly a JOIN weekly b ON a.cluster = b.cluster AND b.week = a.week - 7 WHERE b.score > 0")
def _(d: Data):
    from trendloom.operators import history

    out = history.week_momentum(d.weekly).filter("momentum IS NOT NULL")
    return out.select("cluster", F.col("week").cast("string").alias("week"), F.round("momentum", 6).alias("momentum"))


@query("O8_history_formats", "SELECT cluster, CAST(d AS VARCHAR) AS d, round(score, 2) AS score, CASE WHEN posts % 2 = 0 THEN 0.0 ELSE CAST(posts AS DOUBLE) END AS posts FROM history")
def _(d: Data):
    from trendloom.operators import history

    entry = F.when(F.col("posts") % 2 == 0, F.col("score").cast("string")).otherwise(F.to_json(F.struct("score", F.col("posts").alias("post_count"))))
    rows = d.history.select("cluster", F.col("d").cast("string").alias("d"), entry.alias("e"))
    return history.readable(rows, "cluster", "d", "e").select("cluster", "d", F.round("score", 2).alias("score"), "posts")
