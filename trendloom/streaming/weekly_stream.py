"""The weekly counters as streams: event-time windows of business weeks, and a batch hook that keeps only newest versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendloom.operators.text import is_meta
from trendloom.sources import sinks

#: Windows of seven days that open on Monday 00:00 UTC+05:30.
WEEK_START = "3 days 18 hours 30 minutes"


def tag_weeks(stream: DataFrame, late: str = "7 days") -> DataFrame:
    """week_start, tag, n from a stream of (tag, posted_at); rows later than `late` no longer count."""
    own = stream.withColumn("posted_at", F.col("posted_at").cast("timestamp")).withColumn("tag", F.lower(F.ltrim("tag", F.lit("#"))))
    own = own.filter(~is_meta(F.col("tag")) & (F.col("tag") != "")).withWatermark("posted_at", late)
    return own.groupBy(F.window("posted_at", "7 days", "7 days", WEEK_START).alias("w"), "tag").agg(F.count("*").alias("n")).select(F.col("w.start").alias("week_start"), "tag", "n")


def run_tag_weeks(stream: DataFrame, out: str, checkpoint: str, late: str = "7 days") -> StreamingQuery:
    """Appends finished weeks as Parquet."""
    return tag_weeks(stream, late).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_versions(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends every micro-batch of items as new versions; sinks.latest_view reads the newest of each key.

    The batch number is in the row, so a batch that runs twice after a failure is the same version twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        sinks.append(batch.withColumn("batch", F.lit(number)), out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
