"""Queries over histories, rankings, versions, picks and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import DEDUP
from trendloom.functions import color
from trendloom.functions import columns as C
from trendloom.operators import axes, dedup, distributions, history, palette, ranking, snapshots
from trendloom.plans.cluster_queries import CONTRIB, FAN, MASS, RAW, contributions, groups
from trendloom.plans.registry import Data, query
from trendloom.plans.text_queries import _rule_sql, rules

_DAYS = """h AS (SELECT *, date_diff('day', DATE '1970-01-01', d) AS n FROM history),
 w AS (SELECT cluster, d, score, posts, max(score) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING) AS base,
  coalesce(sum(posts) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) / 7 AS mean,
  coalesce(sum(views) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS v1, coalesce(sum(views) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 14 PRECEDING AND 8 PRECEDING), 0) AS v2,
  coalesce(sum(tags) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS t1, coalesce(sum(tags) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 14 PRECEDING AND 8 PRECEDING), 0) AS t2,
  CAST(coalesce(sum(posts) OVER (PARTITION BY cluster ORDER BY n RANGE BETWEEN 100000 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM h)"""


def _days(d: Data):
    return history.day_features(d.history).withColumn("d", F.col("d").cast("string"))


@query("F2_wow_change", f"WITH {_DAYS} SELECT cluster, CAST(d AS VARCHAR) AS d, round(base, 2) AS base, round(CASE WHEN base > 0 THEN (score - base) * 100 / base ELSE 0 END, 4) AS change_pct FROM w")
def _(d: Data):
    return _days(d).select("cluster", "d", F.round("base", 2).alias("base"), F.round("change_pct", 4).alias("change_pct"))


@query("F4_post_growth", f"WITH {_DAYS} SELECT cluster, CAST(d AS VARCHAR) AS d, round(CASE WHEN mean > 0 THEN (posts - mean) / mean ELSE 0 END, 6) AS post_growth FROM w")
def _(d: Data):
    return _days(d).select("cluster", "d", F.round("post_growth", 6).alias("post_growth"))


@query("F5_view_growth", f"WITH {_DAYS} SELECT cluster, CAST(d AS VARCHAR) AS d, round(CASE WHEN v2 > 0 THEN (v1 - v2) / v2 ELSE 0 END, 6) AS view_growth FROM w")
def _(d: Data):
    return _days(d).select("cluster", "d", F.round("view_growth", 6).alias("view_growth"))


@query("F6_tag_velocity", f"WITH {_DAYS} SELECT cluster, CAST(d AS VARCHAR) AS d, round(CASE WHEN t2 > 0 THEN (t1 - t2) / t2 ELSE 0 END, 6) AS velocity FROM w")
def _(d: Data):
    return _days(d).select("cluster", "d", F.round("velocity", 6).alias("velocity"))


@query("F10_posts_before", f"WITH {_DAYS} SELECT cluster, CAST(d AS VARCHAR) AS d, before AS posts_before FROM w")
def _(d: Data):
    return _days(d).select("cluster", "d", F.col("posts_before").cast("bigint").alias("posts_before"))


@query("J7_direction", f"WITH {_DAYS}, p AS (SELECT cluster, d, CASE WHEN base > 0 THEN (score - base) * 100 / base ELSE 0 END AS p FROM w) SELECT cluster, CAST(d AS VARCHAR) AS d, CASE WHEN p >= 5 THEN 'up' WHEN p <= -5 THEN 'down' ELSE 'flat' END AS direction FROM p")
def _(d: Data):
    return _days(d).select("cluster", "d", C.direction(F.col("change_pct")).alias("direction"))


@query("J9_data_maturity", "WITH x AS (SELECT cluster, count(*) AS n FROM history WHERE d >= DATE '2024-01-23' GROUP BY cluster) SELECT cluster, CASE WHEN n < 3 THEN 'bootstrap' WHEN n < 7 THEN 'partial' ELSE 'full' END AS maturity FROM x")
def _(d: Data):
    x = d.history.filter("d >= DATE '2024-01-23'").groupBy("cluster").agg(F.count("*").alias("n"))
    return x.select("cluster", C.data_maturity(F.col("n")).alias("maturity"))


@query("D10_new_entity_ratio", """WITH t AS (SELECT cluster, account FROM accounts WHERE d = DATE '2024-01-20'), s AS (SELECT DISTINCT cluster, account FROM accounts WHERE d < DATE '2024-01-20' AND d >= DATE '2024-01-20' - 90)
 SELECT t.cluster, round(avg(CASE WHEN s.account IS NULL THEN 1.0 ELSE 0.0 END), 6) AS ratio, CAST(count(*) AS BIGINT) AS n FROM t LEFT JOIN s ON t.cluster = s.cluster AND t.account = s.account GROUP BY t.cluster""")
def _(d: Data):
    return history.new_entity_ratio(d.accounts, "2024-01-20").withColumn("ratio", F.round("ratio", 6))


_TRAJ = """slots AS (SELECT CAST(unnest(generate_series(DATE '2000-10-09', DATE '2000-12-25', INTERVAL 7 DAY)) AS DATE) AS week), cl AS (SELECT DISTINCT cluster FROM weekly WHERE week BETWEEN DATE '2000-10-09' AND DATE '2000-12-25'),
 g AS (SELECT cl.cluster, slots.week, coalesce(w.score, 0.0) AS score FROM cl CROSS JOIN slots LEFT JOIN weekly w ON w.cluster = cl.cluster AND w.week = slots.week), tr AS (SELECT cluster, list(score ORDER BY week) AS v FROM g GROUP BY cluster)"""


@query("F8_trajectory_12w", f"WITH {_TRAJ} SELECT cluster, array_to_string(list_transform(v, lambda x: CAST(CAST(round(x * 100) AS BIGINT) AS VARCHAR)), ',') AS scores FROM tr")
def _(d: Data):
    return history.trajectory(d.weekly, "2000-12-25").select("cluster", F.array_join(F.transform("values", lambda x: F.round(x * 100).cast("bigint").cast("string")), ",").alias("scores"))


@query("F11_streak", f"""WITH {_TRAJ}, s AS (SELECT cluster, list_reverse(list_transform(generate_series(1, 11), lambda i: CASE WHEN v[i] <= 0 THEN 'flat' WHEN (v[i + 1] - v[i]) / v[i] * 100 >= 5 THEN 'up' WHEN (v[i + 1] - v[i]) / v[i] * 100 <= -5 THEN 'down' ELSE 'flat' END)) AS st FROM tr)
 SELECT cluster, CASE WHEN st[1] = 'flat' THEN 0 ELSE CAST(coalesce(list_position(list_transform(st, lambda x: x <> st[1]), TRUE) - 1, 11) AS INT) END AS streak, st[1] AS direction FROM s""")
def _(d: Data):
    return history.trajectory(d.weekly, "2000-12-25").select("cluster", history.streak(F.col("values")).alias("streak"), history.streak_direction(F.col("values")).alias("direction"))


@query("F12_band", f"WITH {_TRAJ} SELECT cluster, len(list_filter(v[9:12], lambda x: x >= 10 AND x <= 1000)) = 4 AS stable FROM tr")
def _(d: Data):
    return history.trajectory(d.weekly, "2000-12-25").select("cluster", history.within_band(F.col("values"), 4, 10, 1000).alias("stable"))


@query("F17_iso_week", "SELECT DISTINCT strftime(post_date, '%G-W%V') AS iso_week, CAST(CAST(date_trunc('week', post_date) AS DATE) AS VARCHAR) AS monday FROM items")
def _(d: Data):
    return d.items.select(C.iso_week(F.col("post_date")).alias("iso_week"), C.monday(F.col("post_date")).cast("string").alias("monday")).distinct()


@query("E27_monthly_avg", "SELECT cluster, CAST(CAST(date_trunc('month', week) AS DATE) AS VARCHAR) AS month, round(sum(score) / 4, 4) AS avg_score, CAST(count(*) AS BIGINT) AS n_weeks FROM weekly GROUP BY 1, 2")
def _(d: Data):
    m = history.monthly_average(d.weekly)
    return m.select("cluster", F.col("month").cast("string").alias("month"), F.round("avg_score", 4).alias("avg_score"), "n_weeks")


_WD = """b AS (SELECT split_part(cluster, '__', 1) AS kind, split_part(cluster, '__', 2) AS value, week, score / sum(score) OVER (PARTITION BY split_part(cluster, '__', 1), week) AS pct, sum(n) OVER (PARTITION BY split_part(cluster, '__', 1), week) AS weight
 FROM weekly WHERE week >= DATE '2000-11-27' AND score > 0)"""


@query("E28_weighted_average", f"WITH {_WD}, t AS (SELECT kind, sum(weight) AS total FROM (SELECT DISTINCT kind, week, weight FROM b) GROUP BY kind) SELECT kind, value, round(sum(pct * weight) / any_value(total), 6) AS pct FROM b JOIN t USING (kind) GROUP BY kind, value")
def _(d: Data):
    from pyspark.sql import Window

    per = Window.partitionBy("kind", "week")
    w = d.weekly.filter("week >= DATE '2000-11-27' AND score > 0").select(F.split_part("cluster", F.lit("__"), F.lit(1)).alias("kind"), F.split_part("cluster", F.lit("__"), F.lit(2)).alias("value"), "week", "score", "n")
    w = w.select("kind", "value", F.col("week").alias("period"), (F.col("score") / F.sum("score").over(per)).alias("pct"), F.sum("n").over(per).alias("weight"))
    return distributions.weighted_average(w, "kind").withColumn("pct", F.round("pct", 6))


@query("E29_monthly_snapshot", """WITH m AS (SELECT cluster, sum(score) / 4 AS avg_score, count(*) AS n_weeks, sum(n) AS n FROM weekly WHERE week BETWEEN DATE '2000-12-04' AND DATE '2000-12-25' GROUP BY cluster)
 SELECT cluster, round(avg_score, 4) AS avg_score, CAST(n_weeks AS BIGINT) AS n_weeks, CAST(n AS BIGINT) AS n FROM m ORDER BY round(avg_score, 6) DESC, cluster LIMIT 5""")
def _(d: Data):
    m = d.weekly.filter("week BETWEEN DATE '2000-12-04' AND DATE '2000-12-25'").groupBy("cluster").agg((F.sum("score") / 4).alias("s"), F.count("*").alias("n_weeks"), F.sum("n").alias("n"))
    return m.orderBy(F.desc(F.round("s", 6)), "cluster").limit(5).select("cluster", F.round("s", 4).alias("avg_score"), "n_weeks", "n")


@query("E30_axis_rollup", "SELECT split_part(cluster, '__', 1) AS axis, CAST(week AS VARCHAR) AS week, round(sum(score), 4) AS score FROM weekly GROUP BY 1, 2")
def _(d: Data):
    return d.weekly.groupBy(F.split_part("cluster", F.lit("__"), F.lit(1)).alias("axis"), F.col("week").cast("string").alias("week")).agg(F.round(F.sum("score"), 4).alias("score"))


@query("H4_keys_union", "SELECT cluster FROM weekly WHERE week = DATE '2000-12-25' UNION SELECT cluster FROM weekly WHERE week = DATE '2000-12-18'")
def _(d: Data):
    w = lambda x: d.weekly.filter(F.col("week") == F.lit(x).cast("date")).select("cluster")
    return w("2000-12-25").union(w("2000-12-18")).distinct()


@query("D20_rank_full_outer", """WITH a AS (SELECT cluster, row_number() OVER (ORDER BY score DESC, cluster) AS r FROM weekly WHERE week = DATE '2000-12-18'), b AS (SELECT cluster, row_number() OVER (ORDER BY score DESC, cluster) AS r FROM weekly WHERE week = DATE '2000-12-25')
 SELECT coalesce(a.cluster, b.cluster) AS cluster, CAST(a.r AS INT) AS old_rank, CAST(b.r AS INT) AS new_rank FROM (SELECT * FROM a WHERE r <= 10) a FULL JOIN (SELECT * FROM b WHERE r <= 10) b ON a.cluster = b.cluster""")
def _(d: Data):
    w = lambda x: d.weekly.filter(F.col("week") == F.lit(x).cast("date")).select("cluster", F.col("score").alias("value"))
    return ranking.rank_change(w("2000-12-18"), w("2000-12-25"), 10)


@query("O10_score_matrix", "SELECT cluster, round(coalesce(sum(score) FILTER (week = DATE '2000-12-11'), 0), 4) AS w1, round(coalesce(sum(score) FILTER (week = DATE '2000-12-18'), 0), 4) AS w2, round(coalesce(sum(score) FILTER (week = DATE '2000-12-25'), 0), 4) AS w3 FROM weekly GROUP BY cluster")
def _(d: Data):
    at = lambda x: F.round(F.coalesce(F.sum(F.when(F.col("week") == F.lit(x).cast("date"), F.col("score"))), F.lit(0.0)), 4)
    return d.weekly.groupBy("cluster").agg(at("2000-12-11").alias("w1"), at("2000-12-18").alias("w2"), at("2000-12-25").alias("w3"))


@query("F1_snapshot_dedup", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY url_tag ORDER BY posted_at DESC, {RAW} DESC, item_id) AS r FROM items)
 SELECT item_id, url_tag FROM r WHERE url_tag IS NULL OR r = 1""")
def _(d: Data):
    return snapshots.dedup(d.items).select("item_id", "url_tag")


@query("O9_dedup_by_engagement", f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY url_tag ORDER BY {RAW} DESC, item_id) AS r FROM items) SELECT item_id, url_tag FROM r WHERE url_tag IS NULL OR r = 1")
def _(d: Data):
    return snapshots.dedup_by_engagement(d.items).select("item_id", "url_tag")


@query("K1_item_latest", "SELECT i.item_id, i.source, coalesce(i.url_tag, i.item_id) AS k, CAST(i.post_date AS VARCHAR) AS post_date FROM items i JOIN (SELECT source, coalesce(url_tag, item_id) AS k, max(post_date) AS m FROM items GROUP BY ALL) x ON x.source = i.source AND x.k = coalesce(i.url_tag, i.item_id) AND x.m = i.post_date")
def _(d: Data):
    k = F.coalesce("url_tag", "item_id")
    return history.latest(d.items.withColumn("k", k), [F.col("source"), F.col("k")], "post_date").select("item_id", "source", "k", F.col("post_date").cast("string").alias("post_date"))


@query("K4_representative_latest", "WITH m AS (SELECT cluster, max(week) AS m FROM weekly WHERE len(string_split(cluster, '__')) = 2 GROUP BY cluster) SELECT w.cluster, CAST(w.week AS VARCHAR) AS week, round(w.score, 4) AS score FROM weekly w JOIN m ON m.cluster = w.cluster AND m.m = w.week")
def _(d: Data):
    two = d.weekly.filter(F.size(F.split("cluster", "__")) == 2)
    return history.latest(two, [F.col("cluster")], "week").select("cluster", F.col("week").cast("string").alias("week"), F.round("score", 4).alias("score"))


@query("D1_profile_left_join", "WITH p AS (SELECT handle, max(followers) AS f FROM items WHERE seq % 3 = 0 GROUP BY handle) SELECT item_id, coalesce(p.f, 0) AS followers FROM items LEFT JOIN p USING (handle)")
def _(d: Data):
    p = d.items.filter("seq % 3 = 0").groupBy("handle").agg(F.max("followers").alias("f"))  # one row for each handle before the join
    return d.items.select("item_id", "handle").join(p, "handle", "left").select("item_id", F.coalesce("f", F.lit(0)).alias("followers"))


@query("A10_page_scan", "WITH r AS (SELECT item_id, row_number() OVER (ORDER BY posted_at, item_id) AS r FROM items) SELECT item_id FROM r WHERE r > 200 AND r <= 300")
def _(d: Data):
    return d.items.orderBy("posted_at", "item_id").offset(200).limit(100).select("item_id")


@query("A12_date_scan", "SELECT o_orderkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'")
def _(d: Data):
    return d.table("orders").filter("o_orderdate >= TIMESTAMP_NTZ '1996-03-01' AND o_orderdate < TIMESTAMP_NTZ '1996-04-01'").select(F.col("o_orderkey").alias("k"))


@query("A13_id_scan", "SELECT item_id, source FROM items WHERE item_id IN (SELECT item_id FROM captions WHERE caption LIKE '%nobody%')")
def _(d: Data):
    ids = d.captions.filter(F.contains("caption", F.lit("nobody"))).select("item_id")
    return d.items.join(ids, "item_id", "left_semi").select("item_id", "source")


@query("G2_top_posts", f"""WITH {MASS}, x AS (SELECT cluster, item_id, seq, canonical_index, round((likes + 2 * comments) * share, 6) AS value FROM mass JOIN items USING (item_id) WHERE source = 'instagram'),
 r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY value DESC, seq, canonical_index) AS rank FROM x) SELECT cluster, CAST(rank AS INT) AS rank, item_id, round(value, 4) AS value FROM r WHERE rank <= 10""")
def _(d: Data):
    return ranking.top_posts(axes.fanout_mass(groups(d)), d.items).withColumn("value", F.round("value", 4))


@query("G3_top_influencers", f"""WITH {MASS}, x AS (SELECT cluster, handle, max(round((likes + 2 * comments) * share, 6)) AS value FROM mass JOIN items USING (item_id) WHERE source = 'instagram' GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY value DESC, handle) AS rank FROM x) SELECT cluster, CAST(rank AS INT) AS rank, handle, round(value, 4) AS value FROM r WHERE rank <= 10""")
def _(d: Data):
    return ranking.top_influencers(axes.fanout_mass(groups(d)), d.items).withColumn("value", F.round("value", 4))


@query("G4_first_videos", f"""WITH {FAN}, r AS (SELECT cluster, item_id, row_number() OVER (PARTITION BY cluster ORDER BY seq, item_id) AS rank FROM fan JOIN items USING (item_id) WHERE source = 'youtube') SELECT cluster, CAST(rank AS INT) AS rank, item_id FROM r WHERE rank <= 10""")
def _(d: Data):
    return ranking.first_videos(axes.fanout_normalized(groups(d)), d.items)


_PICKS = f"""{FAN}, x AS (SELECT cluster, source, seq, item_id, {RAW} AS e FROM fan JOIN items USING (item_id) WHERE round(share, 9) >= 0.1), pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster, source ORDER BY e DESC, seq, item_id) AS rank FROM x) WHERE rank <= CASE source WHEN 'instagram' THEN 5 ELSE 1 END)"""


def _picks(d: Data):
    fan = axes.fanout_normalized(groups(d)).withColumn("share", F.round("share", 9))
    return ranking.cluster_picks(fan, d.items)


@query("G5_cluster_picks", f"WITH {_PICKS} SELECT cluster, source, CAST(rank AS INT) AS rank, item_id FROM pk")
def _(d: Data):
    return _picks(d)


_TARGETS = "ft AS (SELECT * FROM (SELECT item_id, source, row_number() OVER (PARTITION BY source ORDER BY seq, item_id) AS rank FROM ru JOIN items USING (item_id) WHERE garment IS NULL) WHERE rank <= 50)"


@query("C22_first_targets", f"WITH {_rule_sql()}, {_TARGETS} SELECT source, CAST(rank AS INT) AS rank, item_id FROM ft")
def _(d: Data):
    items = d.items.join(rules(d).select("item_id", "garment"), "item_id")
    return ranking.first_targets(items, 50).select("source", "rank", "item_id")


@query("D11_anti_picks", f"WITH {_PICKS} SELECT DISTINCT item_id FROM pk WHERE item_id NOT IN (SELECT item_id FROM captions WHERE caption LIKE '%SAREE%')")
def _(d: Data):
    first = d.captions.filter(F.contains("caption", F.lit("SAREE"))).select("item_id")
    return _picks(d).select("item_id").distinct().join(first, "item_id", "left_anti")


@query("G6_winner_key", f"WITH {FAN} SELECT item_id, arg_min(cluster, (-round(share, 9), cluster)) AS cluster FROM fan GROUP BY item_id")
def _(d: Data):
    return ranking.winner(axes.fanout_normalized(groups(d)))


@query("G7_summary_order", f"WITH {CONTRIB}, t AS (SELECT cluster, round(sum(contribution), 6) AS total FROM c GROUP BY cluster) SELECT CAST(row_number() OVER (ORDER BY total DESC, cluster) AS INT) AS place, cluster, total FROM t")
def _(d: Data):
    from pyspark.sql import Window

    t = axes.representatives(contributions(d)).select("cluster", F.round("total", 6).alias("total"))
    return t.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("total"), "cluster")))  # one row for each cluster


@query("F16_partial_assign")
def _(d: Data):
    own = rules(d).select("item_id", F.col("garment").alias("g"), F.col("fabric").alias("f")).join(d.items.select("item_id", "seq", "post_date"), "item_id")
    return ranking.partial_assignment(own, "post_date")


_LIN = lambda c: f"CASE WHEN {c} / 255.0 > 0.04045 THEN pow(({c} / 255.0 + 0.055) / 1.055, 2.4) ELSE {c} / 255.0 / 12.92 END"
_LAB = f"""hx AS (SELECT DISTINCT hex, concat('0x', substr(hex, 2, 2))::INT::DOUBLE AS r, concat('0x', substr(hex, 4, 2))::INT::DOUBLE AS g, concat('0x', substr(hex, 6, 2))::INT::DOUBLE AS b FROM groups),
 li AS (SELECT hex, {_LIN("r")} AS lr, {_LIN("g")} AS lg, {_LIN("b")} AS lb FROM hx),
 xyz AS (SELECT hex, (lr * 0.4124564 + lg * 0.3575761 + lb * 0.1804375) / 0.95047 AS x, (lr * 0.2126729 + lg * 0.7151522 + lb * 0.0721750) / 1.0 AS y, (lr * 0.0193339 + lg * 0.1191920 + lb * 0.9503041) / 1.08883 AS z FROM li),
 ff AS (SELECT hex, {", ".join(f"CASE WHEN {c} > 216 / 24389 THEN cbrt({c}) ELSE (24389 / 27 * {c} + 16) / 116 END AS f{c}" for c in "xyz")} FROM xyz),
 lab AS (SELECT hex, 116 * fy - 16 AS l, 500 * (fx - fy) AS a, 200 * (fy - fz) AS b FROM ff),
 fam AS (SELECT *, CASE WHEN sqrt(a * a + b * b) < 12 AND l > 85 THEN 'white_on_white' WHEN sqrt(a * a + b * b) < 12 THEN 'neutral' WHEN l > 70 AND sqrt(a * a + b * b) <= 55 THEN 'pastel' WHEN l > 25 AND l < 65 AND a > 0 AND b > 10 AND sqrt(a * a + b * b) <= 55 THEN 'earth'
  WHEN l <= 45 AND sqrt(a * a + b * b) >= 20 THEN 'jewel' WHEN sqrt(a * a + b * b) > 55 THEN 'bright' ELSE 'jewel' END AS family FROM lab)"""


def lab_colors(d: Data):
    h = d.lines("groups").select("hex").distinct()
    return h.select("hex", *[c.alias(n) for c, n in zip(color.rgb_lab(*color.hex_channels(F.col("hex"))), ("l", "a", "b"), strict=True)])


@query("I_rgb_lab", f"WITH {_LAB} SELECT hex, round(l, 5) AS l, round(a, 5) AS a, round(b, 5) AS b FROM lab")
def _(d: Data):
    return lab_colors(d).select("hex", *[F.round(c, 5).alias(c) for c in ("l", "a", "b")])


@query("I_color_family", f"WITH {_LAB} SELECT family, CAST(count(*) AS BIGINT) AS n FROM fam GROUP BY family")
def _(d: Data):
    return lab_colors(d).groupBy(color.family(F.col("l"), F.col("a"), F.col("b")).alias("family")).agg(F.count("*").alias("n"))


@query("I_hue_skin", f"WITH {_LAB} SELECT hex, round(CASE WHEN degrees(atan2(b, a)) < 0 THEN degrees(atan2(b, a)) + 360 ELSE degrees(atan2(b, a)) END, 4) AS hue, l BETWEEN 20 AND 90 AND a BETWEEN 5 AND 30 AND b BETWEEN 8 AND 40 AS skin FROM lab")
def _(d: Data):
    return lab_colors(d).select("hex", F.round(color.hue(F.col("a"), F.col("b")), 4).alias("hue"), color.is_skin(F.col("l"), F.col("a"), F.col("b")).alias("skin"))


@query("D14_preset_nearest", f"""WITH {_LAB}, pr AS (SELECT hex AS preset, l AS pl, a AS pa, b AS pb FROM lab ORDER BY hex LIMIT 50), x AS (SELECT hex, preset, round(sqrt((l - pl) * (l - pl) + (a - pa) * (a - pa) + (b - pb) * (b - pb)), 6) AS d FROM lab, pr)
 SELECT hex, arg_min(preset, (d, preset)) AS preset, round(min(d), 4) AS distance FROM x GROUP BY hex""")
def _(d: Data):
    own = lab_colors(d)
    presets = own.orderBy("hex").limit(50).select(F.struct(F.col("hex").alias("preset"), F.col("l").alias("pl"), F.col("a").alias("pa"), F.col("b").alias("pb")).alias("p"))
    listed = presets.agg(F.collect_list("p").alias("ps"))  # 50 presets in one row
    dist = lambda p: F.round(color.delta_e([F.col("l"), F.col("a"), F.col("b")], [p["pl"], p["pa"], p["pb"]]), 6)
    best = F.array_min(F.transform("ps", lambda p: F.struct(dist(p).alias("d"), p["preset"].alias("preset"))))
    return own.crossJoin(F.broadcast(listed)).withColumn("best", best).select("hex", F.col("best.preset").alias("preset"), F.round("best.d", 4).alias("distance"))


@query("E36_lab_percentiles", f"WITH {_LAB} SELECT round(quantile_cont(l, 0.01), 4) AS p1, round(quantile_cont(l, 0.5), 4) AS p50, round(quantile_cont(l, 0.99), 4) AS p99, round(avg(l), 4) AS mean, round(stddev_pop(l), 4) AS std FROM lab")
def _(d: Data):
    p = lambda q: F.round(F.percentile("l", F.lit(q)), 4)
    return lab_colors(d).agg(p(0.01).alias("p1"), p(0.5).alias("p50"), p(0.99).alias("p99"), F.round(F.avg("l"), 4).alias("mean"), F.round(F.stddev_pop("l"), 4).alias("std"))


def _outfits(d: Data):
    g = groups(d)
    presets = F.array(F.concat(F.lit("p"), (F.col("n_objects") % 3).cast("string")), F.concat(F.lit("q"), (F.length("upper_word") % 2).cast("string")), F.coalesce("silhouette", F.lit("none")))
    return g.select(F.col("item_id").alias("post_id"), F.col("canonical_index").cast("bigint").alias("i"), F.concat(F.lit("img"), (F.col("canonical_index") % 3).cast("string")).alias("image_id"), "area", presets.alias("presets"), F.col("fabric").alias("family"), F.col("upper_word").alias("upper"), F.col("lower_word").alias("lower"), F.col("dress_as_single").alias("single"), "technique")


@query("D13_outfit_pairs", f"""WITH {MASS}, o AS (SELECT item_id, CAST(canonical_index AS BIGINT) AS i, [concat('p', CAST(n_objects % 3 AS VARCHAR)), concat('q', CAST(length(upper_word) % 2 AS VARCHAR)), coalesce(silhouette, 'none')] AS presets, fabric, upper_word AS u, lower_word AS lo, dress_as_single AS s, technique AS te FROM n),
 p AS (SELECT a.item_id AS post_id, a.i, b.i AS j, round(CASE WHEN len(list_intersect(a.presets, b.presets)) >= 2 THEN 0.4 ELSE 0 END + CASE WHEN a.fabric = b.fabric THEN 0.25 ELSE 0 END
  + CASE WHEN a.u = b.u AND (coalesce(a.s, FALSE) OR coalesce(b.s, FALSE) OR coalesce(a.lo = b.lo, FALSE)) THEN 0.25 ELSE 0 END + CASE WHEN a.te = b.te THEN 0.1 ELSE 0 END, 6) AS similarity FROM o a JOIN o b ON a.item_id = b.item_id AND a.i < b.i)
 SELECT post_id, i, j, similarity::DOUBLE AS similarity FROM p WHERE similarity >= {DEDUP.threshold}""")
def _(d: Data):
    return dedup.similar_pairs(_outfits(d))


@query("L2_outfit_dedup")
def _(d: Data):
    return dedup.merged(_outfits(d))


@query("L13_cluster_palette")
def _(d: Data):
    own = axes.fanout_mass(groups(d)).join(d.groups.select("item_id", "canonical_index", "hex"), ["item_id", "canonical_index"])
    return palette.group_palettes(own.select("cluster", "hex", F.col("share").alias("weight")), "cluster")


@query("L12_post_palette")
def _(d: Data):
    return palette.group_palettes(d.groups.select("item_id", "hex", F.col("area").alias("weight")), "item_id", k=3)


@query("L4_pixel_palette")
def _(d: Data):
    lab = color.rgb_lab(*color.hex_channels(F.col("hex")))
    return palette.pixel_palettes(d.lines("groups").select("silhouette", *[c.alias(n) for c, n in zip(lab, ("l", "a", "b"), strict=True)]), "silhouette")


@query("E34_technique_words", "SELECT lower(trim(technique_word)) AS word, CAST(count(*) AS BIGINT) AS n FROM groups WHERE technique_word IS NOT NULL GROUP BY 1")
def _(d: Data):
    return d.lines("groups").filter(F.col("technique_word").isNotNull()).groupBy(F.lower(F.trim("technique_word")).alias("word")).agg(F.count("*").alias("n"))


@query("J15_vision_words", """WITH w AS (SELECT item_id, 'vision_garment' AS kind, lower(trim(upper_word)) AS word FROM groups UNION ALL SELECT item_id, 'vision_fabric', lower(trim(fabric_word)) FROM groups UNION ALL SELECT item_id, 'vision_technique', lower(trim(technique_word)) FROM groups)
 SELECT DISTINCT item_id, kind, word FROM w WHERE word IS NOT NULL""")
def _(d: Data):
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lower(F.trim(c)).alias("word")) for k, c in (("vision_garment", "upper_word"), ("vision_fabric", "fabric_word"), ("vision_technique", "technique_word"))])
    return d.groups.select("item_id", F.inline(kinds)).filter(F.col("word").isNotNull()).distinct()


@query("E37_quality_mix", f"""WITH {CONTRIB} SELECT source, CASE WHEN contains(cluster, 'unknown') THEN 'partial' ELSE 'exact' END AS kind, CAST(count(*) AS BIGINT) AS n, round(sum(contribution), 6) AS mass FROM c GROUP BY ALL""")
def _(d: Data):
    kind = F.when(F.contains("cluster", F.lit("unknown")), "partial").otherwise("exact")
    return contributions(d).groupBy("source", kind.alias("kind")).agg(F.count("*").alias("n"), F.round(F.sum("contribution"), 6).alias("mass"))


@query("E39_row_counts", "SELECT 'orders' AS t, CAST(count(*) AS BIGINT) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def _(d: Data):
    one = lambda t: d.table(t).agg(F.lit(t).alias("t"), F.count("*").alias("n"))
    return one("orders").union(one("lineitem")).union(one("events"))


@query("E40_pick_counts", f"WITH {_PICKS}, hh AS (SELECT cluster, hex FROM pk JOIN groups USING (item_id)) SELECT cluster, hex, CAST(count(*) AS BIGINT) AS n FROM hh GROUP BY ALL HAVING count(*) > 1")
def _(d: Data):
    return _picks(d).select("cluster", "item_id").join(d.groups.select("item_id", "hex"), "item_id").groupBy("cluster", "hex").agg(F.count("*").alias("n")).filter("n > 1")


@query("O1_object_weight", "SELECT item_id, round(sum(log2(100 * greatest(area, 0) + 1)), 6) AS w FROM groups GROUP BY item_id")
def _(d: Data):
    return d.groups.groupBy("item_id").agg(F.round(F.sum(C.object_weight(F.col("area"))), 6).alias("w"))


@query("I_box_iou", "WITH b AS (SELECT DISTINCT l_partkey % 10 AS i, l_discount AS w FROM lineitem) SELECT i, w, round(CASE WHEN (greatest(least(i / 10.0 + w, 0.8) - greatest(i / 10.0, 0.3), 0.0) * 0.5) > 0 THEN (greatest(least(i / 10.0 + w, 0.8) - greatest(i / 10.0, 0.3), 0.0) * 0.5) / (w * 0.5 + 0.25 - (greatest(least(i / 10.0 + w, 0.8) - greatest(i / 10.0, 0.3), 0.0) * 0.5)) ELSE 0 END, 6) AS iou FROM b")
def _(d: Data):
    b = d.table("lineitem").select((F.col("l_partkey") % 10).alias("i"), F.col("l_discount").alias("w")).distinct()
    x = F.col("i") / 10.0
    return b.select("i", "w", F.round(C.iou([x, F.lit(0.2), F.col("w"), F.lit(0.5)], [F.lit(0.3), F.lit(0.2), F.lit(0.5), F.lit(0.5)]), 6).alias("iou"))


@query("O2_null_on_empty", f"SELECT item_id, nullif(array_to_string(list_sort(list(DISTINCT silhouette) FILTER (silhouette IN {tuple(vocab.SILHOUETTES)})), ','), '') AS silhouettes FROM groups GROUP BY item_id")
def _(d: Data):
    return d.groups.groupBy("item_id").agg(F.nullif(F.array_join(F.array_sort(F.collect_set("silhouette")), ","), F.lit("")).alias("silhouettes"))
