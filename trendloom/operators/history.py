"""Windows over daily and weekly histories (cluster, d, ...); gaps are days without rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.functions import columns as C

EPOCH = "1970-01-01"


def _day(c: str = "d") -> Column:
    return F.datediff(F.col(c), F.lit(EPOCH).cast("date"))


def _range(lo: int, hi: int):
    return Window.partitionBy("cluster").orderBy("n").rangeBetween(lo, hi)


def day_features(history: DataFrame, days: int = 7) -> DataFrame:
    """cluster, d, base (score exactly `days` before), change_pct, post_growth, view_growth, velocity."""
    h = history.withColumn("n", _day())
    prior = lambda c: F.coalesce(F.sum(c).over(_range(-days, -1)), F.lit(0))
    older = lambda c: F.coalesce(F.sum(c).over(_range(-2 * days, -days - 1)), F.lit(0))
    mean = prior("posts") / days
    base = F.max("score").over(_range(-days, -days))
    return h.select(
        "cluster", "d", "score", base.alias("base"), C.ratio((F.col("score") - base) * 100, base).alias("change_pct"),
        C.ratio(F.col("posts") - mean, mean).alias("post_growth"), C.ratio(prior("views") - older("views"), older("views")).alias("view_growth"),
        C.ratio(prior("tags") - older("tags"), older("tags")).alias("velocity"), F.coalesce(F.sum("posts").over(_range(-100_000, -1)), F.lit(0)).alias("posts_before"),
    )


def new_entity_ratio(accounts: DataFrame, day: str, days: int = 90) -> DataFrame:
    """cluster, ratio: share of a day's entity rows (duplicates count) whose entity the days before do not have."""
    d = F.lit(day).cast("date")
    today = accounts.filter(F.col("d") == d).select("cluster", "account")
    seen = accounts.filter((F.col("d") < d) & (F.col("d") >= F.date_sub(d, days))).select("cluster", "account").distinct().withColumn("old", F.lit(1))
    return today.join(seen, ["cluster", "account"], "left").groupBy("cluster").agg(F.avg(F.col("old").isNull().cast("double")).alias("ratio"), F.count("*").alias("n"))


def trajectory(weekly: DataFrame, last_week: str, weeks: int = 12) -> DataFrame:
    """cluster, values: scores of the last weeks, oldest first, zero where there is no row."""
    last = F.lit(last_week).cast("date")
    slot = (weeks - 1 - F.datediff(last, F.col("week")) / 7).cast("int")
    own = weekly.filter((F.col("week") <= last) & (F.col("week") > F.date_sub(last, 7 * weeks))).groupBy("cluster", slot.alias("slot")).agg(F.max("score").alias("score"))
    filled = own.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("m"))  # at most `weeks` entries
    return filled.select("cluster", F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("values"))


def streak(values: Column, pct: float = 5.0) -> Column:
    """Length of the run of equal non-flat directions that the series ends with; a step from zero has none."""
    step = lambda a, b: F.when(a <= 0, "flat").otherwise(F.when((b - a) / a * 100 >= pct, "up").when((b - a) / a * 100 <= -pct, "down").otherwise("flat"))
    steps = F.transform(F.sequence(F.size(values) - 1, F.lit(1), F.lit(-1)), lambda i: step(F.element_at(values, i), F.element_at(values, i + 1)))
    first = F.element_at(steps, 1)
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    run = F.aggregate(steps, start, lambda a, s: F.struct((a["n"] + (a["on"] & (s == first) & (s != "flat")).cast("int")).alias("n"), (a["on"] & (s == first)).alias("on")))
    return run["n"]


def streak_direction(values: Column, pct: float = 5.0) -> Column:
    a, b = F.element_at(values, -2), F.element_at(values, -1)
    return F.when(a <= 0, "flat").otherwise(F.when((b - a) / a * 100 >= pct, "up").when((b - a) / a * 100 <= -pct, "down").otherwise("flat"))


def within_band(values: Column, weeks: int, lo: float, hi: float) -> Column:
    return F.forall(F.slice(values, F.size(values) - weeks + 1, F.lit(weeks)), lambda v: (v >= lo) & (v <= hi))


def monthly_average(weekly: DataFrame, weeks: int = 4) -> DataFrame:
    """cluster, month, avg over a fixed number of weeks (missing ones are zero), weeks present."""
    month = F.date_trunc("month", "week").cast("date")
    return weekly.groupBy("cluster", month.alias("month")).agg((F.sum("score") / weeks).alias("avg_score"), F.count("*").alias("n_weeks"))


def latest(rows: DataFrame, keys: list[Column], version: str) -> DataFrame:
    """All rows of each key's newest version; ties stay."""
    w = Window.partitionBy(*keys).orderBy(F.desc(version))
    return rows.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


def week_momentum(weekly: DataFrame) -> DataFrame:
    """cluster, week, momentum: change over the week before, null without one or from zero."""
    before = F.max("score").over(Window.partitionBy("cluster").orderBy("n").rangeBetween(-7, -7))
    return weekly.withColumn("n", _day("week")).select("cluster", "week", F.when(before > 0, (F.col("score") - before) / before).alias("momentum"))


def readable(rows: DataFrame, cluster: str, d: str, entry: str) -> DataFrame:
    """cluster, d, score, posts, views from entries as JSON text: records, or bare numbers of an older format (the score)."""
    bare = F.col(entry).try_cast("double")
    record = F.from_json(entry, "score double, post_count double, youtube_views_total double")
    none = F.lit(0.0)
    return rows.select(
        cluster, d, F.coalesce(bare, record["score"]).alias("score"), F.when(bare.isNull(), F.coalesce(record["post_count"], none)).otherwise(none).alias("posts"), F.when(bare.isNull(), F.coalesce(record["youtube_views_total"], none)).otherwise(none).alias("views")
    )
