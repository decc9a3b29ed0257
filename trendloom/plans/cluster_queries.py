"""Queries over detected groups: normalisation, fan-out, representatives, distributions, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom import vocab
from trendloom.config import EVIDENCE_TOP_K, SCORING
from trendloom.functions import columns as C
from trendloom.operators import axes, distributions, scoring, snapshots
from trendloom.plans.registry import Data, case, query


def _word(c: str) -> str:
    return f"translate(lower(trim({c})), ' -', '__')"


#: A day of the configured festival, for the queries that score.
FESTIVE_DAY = SCORING.festivals[0][0]

#: Groups with their axes, as axes.normalized has them.
NORMAL = f"""n AS (SELECT *, CASE WHEN coalesce(dress_as_single, FALSE) THEN coalesce(upper_is_ethnic, FALSE) ELSE coalesce(upper_is_ethnic, FALSE) OR coalesce(lower_is_ethnic, FALSE) END AS is_ethnic,
  CASE WHEN coalesce(upper_is_ethnic, FALSE) THEN {case(_word("upper_word"), vocab.GARMENT_WORDS)} END AS garment,
  {case(_word("fabric_word"), vocab.FABRIC_WORDS)} AS fabric, {case(_word("technique_word"), vocab.TECHNIQUE_WORDS)} AS technique,
  CASE WHEN coalesce(dress_as_single, FALSE) THEN 'standalone' WHEN coalesce(is_co_ord_set, FALSE) THEN 'co_ord_set'
       ELSE coalesce({case(_word("lower_word"), vocab.STYLING_LOWER)}, {case(_word("outer_word"), vocab.STYLING_OUTER)}) END AS styling,
  CASE WHEN n_objects > 0 THEN log2(n_objects + 1.0) * log2(100 * greatest(area, 0.0) + 1) ELSE 0.0 END AS weight FROM groups)"""
KEY = "concat(coalesce(garment, 'unknown'), '__', coalesce(fabric, 'unknown'))"
MULT = "CASE (split_part(cluster, '__', 1) <> 'unknown')::INT + (split_part(cluster, '__', 2) <> 'unknown')::INT WHEN 2 THEN 2.5 WHEN 1 THEN 1.0 ELSE 0.0 END"
#: Normalised fan-out, as axes.fanout_normalized has it.
FAN = f"""{NORMAL}, k AS (SELECT *, sum(weight) OVER (PARTITION BY item_id) AS t FROM n WHERE is_ethnic AND (garment IS NOT NULL OR fabric IS NOT NULL)),
fan AS (SELECT item_id, {KEY} AS cluster, sum(CASE WHEN t > 0 THEN weight / t ELSE 0 END) AS share FROM k GROUP BY ALL HAVING sum(CASE WHEN t > 0 THEN weight / t ELSE 0 END) > 0)"""
CONTRIB = f"""{FAN}, c AS (SELECT fan.*, i.source, share * {MULT} AS contribution FROM fan JOIN items i USING (item_id))"""
#: Fan-out of mass, as axes.fanout_mass has it.
MASS = f"""{NORMAL}, m AS (SELECT *, log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0) AS g, sum(weight) OVER (PARTITION BY item_id) AS t FROM n WHERE is_ethnic),
mass AS (SELECT item_id, canonical_index, {KEY} AS cluster, CASE WHEN t > 0 THEN g * (weight / t) ELSE 0 END AS share FROM m WHERE garment IS NOT NULL OR fabric IS NOT NULL)"""
RATE = "(likes / greatest(coalesce(followers, 0), 100) + 2 * comments / greatest(coalesce(followers, 0), 100))"
RAW = "(likes + 2 * comments + CASE WHEN source = 'youtube' THEN coalesce(views, 0) ELSE 0 END)"
ENGAGEMENT = f"""{RATE} * CASE WHEN followers >= 1000000 THEN 2.0 WHEN followers >= 100000 THEN 1.5 WHEN followers >= 10000 THEN 1.2 ELSE 1.0 END
 * CASE source_type WHEN 'influencer_fixed' THEN 1.0 WHEN 'hashtag_tracking' THEN 1.2 WHEN 'hashtag_haul' THEN 1.5 WHEN 'bollywood_decode' THEN 1.1 ELSE 1.0 END"""
ACC = f"""{MASS}, acc AS (SELECT cluster, sum(CASE WHEN source = 'instagram' THEN {ENGAGEMENT} * share ELSE 0 END) AS social, sum(CASE WHEN source = 'youtube' THEN share ELSE 0 END) AS videos,
 sum(CASE WHEN source = 'youtube' THEN {RAW} * share ELSE 0 END) AS views, sum(share) AS posts, sum(CASE WHEN source = 'instagram' AND source_type = 'bollywood_decode' THEN share ELSE 0 END) AS presence,
 sum(CASE WHEN item_id IN (SELECT item_id FROM tags WHERE lower(ltrim(tag, '#')) IN ('akshayatritiya', 'akshayatritiya2026', 'goldethnic')) THEN 1.5 * share ELSE 0 END) AS festival FROM mass JOIN items USING (item_id) WHERE share > 0 GROUP BY cluster)"""
RAWF = f"""{ACC}, f AS (SELECT cluster, posts, social AS f1, CASE WHEN videos > 0 OR views > 0 THEN 0.3 * videos + 0.4 * views ELSE 0 END AS f2, 0.6 * festival + 0.4 * presence AS f3 FROM acc),
l AS (SELECT min(f1) a1, max(f1) b1, min(f2) a2, max(f2) b2, min(f3) a3, max(f3) b3 FROM f),
s AS (SELECT cluster, posts, CASE WHEN b1 > a1 THEN 40 * ((f1 - a1) / (b1 - a1)) ELSE 0.0 END AS social, CASE WHEN b2 > a2 THEN 25 * ((f2 - a2) / (b2 - a2)) ELSE 0.0 END AS youtube,
 CASE WHEN b3 > a3 THEN 15 * ((f3 - a3) / (b3 - a3)) ELSE 0.0 END AS cultural, 0.0 AS momentum FROM f, l)"""


def groups(d: Data) -> DataFrame:
    return axes.normalized(d.groups)


def _r(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def acc(d: Data) -> DataFrame:
    """The accumulators on a day inside the festival."""
    return scoring.accumulators(axes.fanout_mass(groups(d)), d.items, SCORING, scoring.festival_items(d.tags, FESTIVE_DAY))


def contributions(d: Data) -> DataFrame:
    return axes.contributions(axes.fanout_normalized(groups(d)), d.items)


@query("C9_ethnic_flag", f"WITH {NORMAL} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, is_ethnic FROM n")
def _(d: Data):
    return groups(d).select("item_id", F.col("canonical_index").cast("bigint").alias("canonical_index"), "is_ethnic")


@query("C10_axis_normalize", f"WITH {NORMAL} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, garment, fabric, technique FROM n")
def _(d: Data):
    return groups(d).select("item_id", F.col("canonical_index").cast("bigint").alias("canonical_index"), "garment", "fabric", "technique")


@query("C14_styling_derive", f"WITH {NORMAL} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, styling FROM n")
def _(d: Data):
    return groups(d).select("item_id", F.col("canonical_index").cast("bigint").alias("canonical_index"), "styling")


@query("C15_embellishment", f"WITH {NORMAL} SELECT {case('technique', vocab.EMBELLISHMENT)} AS level, CAST(count(*) AS BIGINT) AS n_groups FROM n GROUP BY 1")
def _(d: Data):
    return groups(d).groupBy(C.lookup(F.col("technique"), vocab.EMBELLISHMENT).alias("level")).agg(F.count("*").alias("n_groups"))


@query("C23_display_name", f"WITH {FAN} SELECT DISTINCT cluster, concat(replace(split_part(cluster, '__', 1), '_', ' '), ' / ', replace(split_part(cluster, '__', 2), '_', ' ')) AS name FROM fan")
def _(d: Data):
    return axes.fanout_normalized(groups(d)).select("cluster").distinct().withColumn("name", C.display_name(F.col("cluster")))


@query("E1_group_contrib", f"WITH {NORMAL} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, round(weight, 6) AS weight FROM n")
def _(d: Data):
    return _r(groups(d).select("item_id", F.col("canonical_index").cast("bigint").alias("canonical_index"), "weight"), "weight")


@query("E2_item_total", f"WITH {NORMAL} SELECT DISTINCT item_id, round(log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0), 6) AS g_total FROM n")
def _(d: Data):
    return _r(groups(d).groupBy("item_id").agg(F.log2(F.sum("n_objects") + F.lit(1.0)).alias("g_total")), "g_total")


@query("E3_group_share", f"WITH {MASS} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, round(CASE WHEN t > 0 THEN g * (weight / t) ELSE 0 END, 6) AS g_share FROM m")
def _(d: Data):
    own = axes.item_mass(groups(d).filter("is_ethnic"))
    return _r(own.select("item_id", F.col("canonical_index").cast("bigint").alias("canonical_index"), "g_share"), "g_share")


def _distribution_sql(attribute: str, where: str) -> str:
    return f"""WITH {NORMAL}, m AS (SELECT *, log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0) AS g, sum(weight) OVER (PARTITION BY item_id) AS t FROM n WHERE {where}),
 b AS (SELECT item_id, {attribute} AS value, sum(CASE WHEN t > 0 THEN g * (weight / t) ELSE 0 END) AS w FROM m WHERE {attribute} IS NOT NULL GROUP BY ALL)
 SELECT item_id, value, round(w / sum(w) OVER (PARTITION BY item_id), 6) AS pct FROM b WHERE w > 0"""


for _name, _attribute, _where in (("E6_garment_distribution", "garment", "is_ethnic"), ("E6_fabric_distribution", "fabric", "is_ethnic"), ("E6_technique_distribution", "technique", "is_ethnic"), ("E7_silhouette_distribution", "silhouette", "TRUE")):

    @query(_name, _distribution_sql(_attribute, _where))
    def _(d: Data, attribute=_attribute, where=_where):
        return _r(distributions.item_distribution(groups(d).filter(where), attribute), "pct")


@query("E8_styling_distribution", f"""WITH {NORMAL}, m AS (SELECT *, log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0) AS g, sum(weight) OVER (PARTITION BY item_id) AS t FROM n),
 u AS (SELECT item_id, styling AS value, CASE WHEN t > 0 THEN g * (weight / t) ELSE 0 END AS w FROM m WHERE styling IS NOT NULL
       UNION ALL SELECT item_id, 'with_dupatta', CASE WHEN seq % 4 = 0 THEN 6.0 ELSE 3.0 END FROM items WHERE seq % 4 < 2),
 b AS (SELECT item_id, value, sum(w) AS w FROM u GROUP BY ALL) SELECT item_id, value, round(w / sum(w) OVER (PARTITION BY item_id), 6) AS pct FROM b WHERE w > 0""")
def _(d: Data):
    text = d.items.filter("seq % 4 < 2").select("item_id", F.lit("with_dupatta").alias("value"), F.when(F.col("seq") % 4 == 0, "rule").otherwise("llm").alias("method"))
    return _r(distributions.item_distribution(groups(d), "styling", text), "pct")


@query("E9_fanout_norm", f"WITH {FAN} SELECT item_id, cluster, round(share, 6) AS share FROM fan")
def _(d: Data):
    return _r(axes.fanout_normalized(groups(d)), "share")


@query("E10_fanout_gmass", f"WITH {MASS} SELECT item_id, CAST(canonical_index AS BIGINT) AS canonical_index, cluster, round(share, 6) AS share FROM mass")
def _(d: Data):
    return _r(axes.fanout_mass(groups(d)).withColumn("canonical_index", F.col("canonical_index").cast("bigint")), "share")


@query("E12_contributions", f"WITH {CONTRIB} SELECT item_id, cluster, source, round(share, 6) AS share, round(contribution, 6) AS contribution FROM c")
def _(d: Data):
    return _r(contributions(d), "share", "contribution")


@query("E13_representatives", f"""WITH {CONTRIB} SELECT cluster, round(sum(contribution), 6) AS total, round(sum(CASE WHEN source = 'instagram' THEN contribution ELSE 0 END) / sum(contribution), 6) AS ig_share,
 round(sum(CASE WHEN source = 'youtube' THEN contribution ELSE 0 END) / sum(contribution), 6) AS yt_share, CAST(count(DISTINCT item_id) AS BIGINT) AS n_items FROM c GROUP BY cluster HAVING sum(contribution) > 0""")
def _(d: Data):
    return _r(axes.representatives(contributions(d)), "total", "ig_share", "yt_share")


@query("E14_effective_count", f"WITH {CONTRIB} SELECT round(sum(share * {MULT}) / 2.5, 6) AS effective_items FROM c")
def _(d: Data):
    return _r(axes.effective_items(contributions(d)), "effective_items")


@query("E15_share_distribution", f"""WITH {MASS}, x AS (SELECT mass.cluster, n.silhouette AS value, sum(mass.share) AS w FROM mass JOIN n USING (item_id, canonical_index) WHERE n.silhouette IS NOT NULL GROUP BY ALL)
 SELECT cluster, value, round(CASE WHEN sum(w) OVER (PARTITION BY cluster) > 0 THEN w / sum(w) OVER (PARTITION BY cluster) ELSE 0 END, 6) AS pct FROM x""")
def _(d: Data):
    g = groups(d)
    rows = axes.fanout_mass(g).join(g.select("item_id", "canonical_index", "silhouette"), ["item_id", "canonical_index"])
    return _r(distributions.share_weighted(rows, "cluster", "silhouette", "share"), "pct")


@query("E16_share_map_distribution", f"""WITH {FAN}, q AS (SELECT *, log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0) AS g, sum(weight) OVER (PARTITION BY item_id) AS t2 FROM n WHERE is_ethnic),
 b AS (SELECT item_id, technique AS value, sum(CASE WHEN t2 > 0 THEN g * (weight / t2) ELSE 0 END) AS w FROM q WHERE technique IS NOT NULL GROUP BY ALL),
 dist AS (SELECT item_id, value, w / sum(w) OVER (PARTITION BY item_id) AS pct FROM b WHERE w > 0),
 x AS (SELECT cluster, value, sum(pct * share) AS w FROM fan JOIN dist USING (item_id) GROUP BY ALL) SELECT cluster, value, round(w / sum(w) OVER (PARTITION BY cluster), 6) AS pct FROM x""")
def _(d: Data):
    g = groups(d)
    dist = distributions.item_distribution(g.filter("is_ethnic"), "technique")
    rows = axes.fanout_normalized(g).join(dist, "item_id").withColumn("w", F.col("pct") * F.col("share"))
    return _r(distributions.share_weighted(rows, "cluster", "value", "w"), "pct")


@query("E17_silhouette_vote", f"WITH {NORMAL} SELECT item_id, arg_min(coalesce(silhouette, '-'), canonical_index) AS vote FROM n GROUP BY item_id")
def _(d: Data):
    return groups(d).groupBy("item_id").agg(F.min_by(F.coalesce("silhouette", F.lit("-")), "canonical_index").alias("vote"))


@query("E18_brand_distribution", f"""WITH {FAN}, b AS (SELECT DISTINCT item_id, name FROM item_brands), bw AS (SELECT *, 1 / (log2(count(*) OVER (PARTITION BY item_id) + 1.0) * count(*) OVER (PARTITION BY item_id)) AS w FROM b),
 r AS (SELECT cluster, name, sum(share * w) AS w FROM fan JOIN bw USING (item_id) GROUP BY ALL), p AS (SELECT *, w / sum(w) OVER (PARTITION BY cluster) AS p FROM r),
 o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(p, 9) DESC, name) AS rank FROM p WHERE p >= 0.05)
 SELECT cluster, CAST(rank AS INT) AS rank, name, round(p / sum(p) OVER (PARTITION BY cluster), 6) AS pct FROM o WHERE rank <= 5""")
def _(d: Data):
    return _r(distributions.brand_distribution(axes.fanout_normalized(groups(d)), d.item_brands), "pct")


@query("E20_cluster_accumulators", f"WITH {ACC} SELECT cluster, round(social, 6) AS social, round(videos, 6) AS videos, round(views, 4) AS views, round(posts, 6) AS posts, round(presence, 6) AS presence, round(festival, 6) AS festival, round((social + views) / CASE WHEN posts > 0 THEN posts ELSE 1 END, 4) AS rate FROM acc")
def _(d: Data):
    return acc(d).select("cluster", *[F.round(c, n).alias(c) for c, n in (("social", 6), ("videos", 6), ("views", 4), ("posts", 6), ("presence", 6), ("festival", 6), ("rate", 4))])


_PARTS = ["garment", "fabric", "technique", "silhouette", "styling"]
_PART_SQL = " UNION ALL ".join(f"SELECT mass.cluster, '{c}' AS part, n.{c} AS value, mass.share FROM mass JOIN n USING (item_id, canonical_index) WHERE n.{c} IS NOT NULL" for c in _PARTS)


@query("E19_drilldown", f"""WITH {MASS}, v AS ({_PART_SQL} UNION ALL SELECT mass.cluster, 'source', source, mass.share FROM mass JOIN items USING (item_id) UNION ALL SELECT mass.cluster, 'source_type', source_type, mass.share FROM mass JOIN items USING (item_id) WHERE source_type IS NOT NULL),
 w AS (SELECT cluster, part, value, sum(share) AS w FROM v GROUP BY ALL) SELECT cluster, part, value, round(CASE WHEN sum(w) OVER (PARTITION BY cluster, part) > 0 THEN w / sum(w) OVER (PARTITION BY cluster, part) ELSE 0 END, 6) AS pct FROM w""")
def _(d: Data):
    own = groups(d)
    mass = axes.fanout_mass(own).join(own.select("item_id", "canonical_index", *_PARTS), ["item_id", "canonical_index"]).join(d.items.select("item_id", "source", "source_type"), "item_id")
    return _r(distributions.drilldown(mass, [*_PARTS, "source", "source_type"]), "pct")


@query("D16_fanout_cross", f"""WITH {NORMAL}, m AS (SELECT *, log2(sum(n_objects) OVER (PARTITION BY item_id) + 1.0) AS g, sum(weight) OVER (PARTITION BY item_id) AS t FROM n WHERE is_ethnic),
 e AS (SELECT *, CASE WHEN t > 0 THEN g * (weight / t) ELSE 0 END AS w0 FROM m),
 a AS (SELECT item_id, garment AS v, sum(w0) AS w FROM e WHERE garment IS NOT NULL GROUP BY ALL), ap AS (SELECT item_id, v, w / sum(w) OVER (PARTITION BY item_id) AS p FROM a WHERE w > 0),
 b AS (SELECT item_id, fabric AS v, sum(w0) AS w FROM e WHERE fabric IS NOT NULL GROUP BY ALL), bp AS (SELECT item_id, v, w / sum(w) OVER (PARTITION BY item_id) AS p FROM b WHERE w > 0)
 SELECT item_id, concat(coalesce(ap.v, 'unknown'), '__', coalesce(bp.v, 'unknown')) AS cluster, round(coalesce(ap.p, 1) * coalesce(bp.p, 1) * CASE WHEN ap.v IS NULL OR bp.v IS NULL THEN 0.5 ELSE 1 END, 6) AS share FROM ap FULL JOIN bp USING (item_id)""")
def _(d: Data):
    g = groups(d).filter("is_ethnic")
    return _r(axes.cross_fanout(distributions.item_distribution(g, "garment"), distributions.item_distribution(g, "fabric")), "share")


@query("F15_minmax", f"WITH {RAWF} SELECT cluster, round(f1, 6) AS f_social, round(CASE WHEN b1 > a1 THEN (f1 - a1) / (b1 - a1) ELSE 0 END, 6) AS scaled FROM f, l")
def _(d: Data):
    raw = scoring.raw_factors(acc(d))
    limits = raw.agg(F.min("f_social").alias("a"), F.max("f_social").alias("b"))
    return raw.crossJoin(F.broadcast(limits)).select("cluster", F.round("f_social", 6).alias("f_social"), F.round(C.ratio(F.col("f_social") - F.col("a"), F.col("b") - F.col("a")), 6).alias("scaled"))


def scored(d: Data) -> DataFrame:
    return scoring.scores(scoring.raw_factors(acc(d)))


@query("J5_score_breakdown", f"WITH {RAWF} SELECT cluster, round(social, 6) AS social, round(youtube, 6) AS youtube, round(cultural, 6) AS cultural, round(momentum, 6) AS momentum, round(social + youtube + cultural + momentum, 6) AS score FROM s")
def _(d: Data):
    return _r(scored(d).drop("posts"), "social", "youtube", "cultural", "momentum", "score")


@query("J8_lifecycle", f"""WITH {RAWF} SELECT cluster, CASE WHEN posts < 10 THEN 'early' WHEN social + youtube + cultural < 30 THEN 'early' WHEN social + youtube + cultural >= 65 THEN 'maturity' ELSE 'growth' END AS stage FROM s""")
def _(d: Data):
    return scored(d).select("cluster", C.lifecycle(F.col("score"), F.col("posts"), F.lit("flat")).alias("stage"))


@query("J12_display_boost", f"""WITH {RAWF}, b AS (SELECT *, social + youtube + cultural + momentum AS score FROM s) SELECT cluster, round(least(score * 2, 100), 6) AS score,
 round(social * CASE WHEN score > 0 THEN least(score * 2, 100) / score ELSE 0 END, 6) AS social, round(youtube * CASE WHEN score > 0 THEN least(score * 2, 100) / score ELSE 0 END, 6) AS youtube,
 round(cultural * CASE WHEN score > 0 THEN least(score * 2, 100) / score ELSE 0 END, 6) AS cultural, 0.0 AS momentum FROM b""")
def _(d: Data):
    return _r(scoring.display_boost(scored(d)), "score", "social", "youtube", "cultural", "momentum")


@query("G1_evidence_top4", f"""WITH {CONTRIB}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster, source ORDER BY round(contribution, 9) DESC, item_id) AS rank FROM c)
 SELECT cluster, source, CAST(rank AS INT) AS rank, item_id, round(contribution, 6) AS contribution FROM r WHERE rank <= {EVIDENCE_TOP_K}""")
def _(d: Data):
    own = contributions(d).withColumn("contribution", F.round("contribution", 9))
    return _r(axes.evidence(own, EVIDENCE_TOP_K).select("cluster", "source", "rank", "item_id", "contribution"), "contribution")


@query("E32_funnel", f"""WITH {NORMAL} SELECT CAST(count(DISTINCT item_id) AS BIGINT) AS items, CAST(count(*) AS BIGINT) AS groups, CAST(count(*) FILTER (is_ethnic) AS BIGINT) AS ethnic, CAST(count(*) FILTER (is_ethnic AND garment IS NOT NULL) AS BIGINT) AS garment,
 CAST(count(*) FILTER (is_ethnic AND fabric IS NOT NULL) AS BIGINT) AS fabric, CAST(count(*) FILTER (is_ethnic AND garment IS NOT NULL AND fabric IS NOT NULL) AS BIGINT) AS both FROM n""")
def _(d: Data):
    on = lambda c: F.count(F.when(c, 1))
    e, g, f = F.col("is_ethnic"), F.col("garment").isNotNull(), F.col("fabric").isNotNull()
    return groups(d).agg(F.countDistinct("item_id").alias("items"), F.count("*").alias("groups"), on(e).alias("ethnic"), on(e & g).alias("garment"), on(e & f).alias("fabric"), on(e & g & f).alias("both"))


@query("E33_drop_reasons", f"""WITH {NORMAL} SELECT source, handle, CASE WHEN NOT is_ethnic THEN 'not ethnic' WHEN garment IS NULL AND fabric IS NULL THEN 'no axis' WHEN weight = 0 THEN 'no weight' ELSE 'kept' END AS reason, CAST(count(*) AS BIGINT) AS n
 FROM n JOIN items USING (item_id) GROUP BY ALL""")
def _(d: Data):
    reason = F.when(~F.col("is_ethnic"), "not ethnic").when(F.col("garment").isNull() & F.col("fabric").isNull(), "no axis").when(F.col("weight") == 0, "no weight").otherwise("kept")
    return groups(d).join(d.items.select("item_id", "source", "handle"), "item_id").groupBy("source", "handle", reason.alias("reason")).agg(F.count("*").alias("n"))


@query("E31_key_match", f"""WITH {CONTRIB}, a AS (SELECT DISTINCT cluster FROM c WHERE contribution > 0), {ACC.split("FROM groups), ", 1)[1]}, b AS (SELECT cluster FROM acc WHERE videos > 50)
 SELECT CAST(count(*) FILTER (a.cluster IS NOT NULL AND b.cluster IS NOT NULL) AS BIGINT) AS matched, CAST(count(*) FILTER (b.cluster IS NULL) AS BIGINT) AS rep_only, CAST(count(*) FILTER (a.cluster IS NULL) AS BIGINT) AS summary_only FROM a FULL JOIN b ON a.cluster = b.cluster""")
def _(d: Data):
    a = axes.representatives(contributions(d)).select("cluster", F.lit(1).alias("a"))
    b = acc(d).filter("videos > 50").select("cluster", F.lit(1).alias("b"))
    has = lambda c: F.count(F.when(c, 1))
    j = a.join(b, "cluster", "full_outer")
    return j.agg(has(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("matched"), has(F.col("b").isNull()).alias("rep_only"), has(F.col("a").isNull()).alias("summary_only"))


@query("H3_keys_except", f"WITH {CONTRIB} SELECT DISTINCT cluster FROM c WHERE source = 'instagram' AND contribution > 2 EXCEPT SELECT DISTINCT cluster FROM c WHERE source = 'youtube' AND contribution > 2")
def _(d: Data):
    c = contributions(d).filter("contribution > 2")
    return c.filter("source = 'instagram'").select("cluster").subtract(c.filter("source = 'youtube'").select("cluster"))


@query("H2_keys_intersect", f"WITH {CONTRIB} SELECT DISTINCT cluster FROM c WHERE source = 'instagram' AND contribution > 2 INTERSECT SELECT DISTINCT cluster FROM c WHERE source = 'youtube' AND contribution > 2")
def _(d: Data):
    c = contributions(d).filter("contribution > 2")
    return c.filter("source = 'instagram'").select("cluster").intersect(c.filter("source = 'youtube'").select("cluster"))


GROWTH = """r0 AS (SELECT source, url_tag, arg_min(metric, (collected_at, snapshot_id)) AS a, arg_max(metric, (collected_at, snapshot_id)) AS b, min(collected_at) AS t0, max(collected_at) AS t1, count(*) AS n FROM snapshots WHERE collected_at IS NOT NULL GROUP BY ALL),
 r AS (SELECT source, url_tag, (b - a) / (trunc(date_diff('microsecond', t0, t1) / 1000000) / 86400.0) AS rate FROM r0 WHERE n >= 2 AND trunc(date_diff('microsecond', t0, t1) / 1000000) > 0)"""


@query("E25_growth_rate", f"WITH {GROWTH} SELECT source, url_tag, round(rate, 6) AS rate FROM r")
def _(d: Data):
    return _r(snapshots.growth_rate(d.snapshots), "rate")


@query("E26_growth_factor", f"WITH {GROWTH} SELECT source, url_tag, round(1 + CASE WHEN max(rate) OVER (PARTITION BY source) > 0 THEN greatest(rate, 0) / max(rate) OVER (PARTITION BY source) ELSE 0 END, 6) AS factor FROM r")
def _(d: Data):
    return _r(snapshots.growth_factor(snapshots.growth_rate(d.snapshots)).select("source", "url_tag", "factor"), "factor")


@query("D6_growth_join", f"""WITH {MASS}, fa AS (SELECT source, concat('T', CAST(CAST(regexp_extract(url_tag, '[0-9]+') AS BIGINT) * 3 AS VARCHAR)) AS url_tag, max(1.0 + (metric % 100) / 100.0) AS factor FROM snapshots GROUP BY ALL)
 SELECT mass.item_id, CAST(canonical_index AS BIGINT) AS canonical_index, cluster, round(share * coalesce(factor, 1.0), 6) AS share FROM mass JOIN items i USING (item_id) LEFT JOIN fa ON fa.source = i.source AND fa.url_tag = i.url_tag""")
def _(d: Data):
    tag = F.concat(F.lit("T"), (F.regexp_extract("url_tag", "[0-9]+", 0).cast("bigint") * 3).cast("string"))
    fa = d.snapshots.groupBy("source", tag.alias("url_tag")).agg(F.max(1.0 + (F.col("metric") % 100) / 100.0).alias("factor"))
    mass = axes.fanout_mass(groups(d)).withColumn("canonical_index", F.col("canonical_index").cast("bigint"))
    return _r(axes.with_growth(mass, d.items, fa), "share")


@query("P1_majority_vote", f"""WITH v AS (SELECT item_id, silhouette AS value, count(*) AS n, round(avg(area), 9) AS a FROM groups WHERE silhouette IS NOT NULL GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, a DESC, list_position({vocab.SILHOUETTES}, value)) AS r FROM v) SELECT item_id, value, CAST(n AS BIGINT) AS n FROM r WHERE r = 1""")
def _(d: Data):
    return distributions.majority(d.groups, ["item_id"], "silhouette", "area", vocab.SILHOUETTES)


@query("J1_social_raw", f"WITH {ACC} SELECT cluster, round(social, 6) AS social FROM acc WHERE social > 0")
def _(d: Data):
    return acc(d).filter("social > 0").select("cluster", F.round("social", 6).alias("social"))
