"""Checked queries of the streaming operators (STM): the stream's end state equals the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog.registry import query
from laurel.session import scratch_path
from laurel.streaming import weekly

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(t):
    return weekly.read_new_files(t.spark, t.sf_dir, EVENTS, glob="events.parquet")


@query("stm_1", "SELECT event_id, user_id, event_type, value FROM events")
def stm_1(t):
    target, checkpoint = scratch_path(t.spark), scratch_path(t.spark)
    rows = events(t).select("event_id", "user_id", "event_type", "value")
    weekly.ingest(rows, target, checkpoint)
    # The second run finds nothing new.
    weekly.ingest(rows, target, checkpoint)
    return t.spark.read.parquet(target)


@query(
    "stm_2",
    """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS rows, ROUND(SUM(value), 4) AS total
FROM events GROUP BY 1, 2""",
)
def stm_2(t):
    # A backlog in five stretches of the month, the newest first; the stream is taken up again for each.
    source, target, checkpoint = (scratch_path(t.spark) for _ in range(3))
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    stretch = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4))
    for number in (4, 3, 2, 1, 0):
        rows.where(stretch == number).write.mode("append").parquet(source)
        stream = weekly.read_new_files(t.spark, source, rows.schema)
        weekly.add_weekly_totals(stream, "ts", ["event_type"], "value", target, checkpoint)
    return weekly.summed_totals(t.spark, target, ["event_type"]).withColumn("total", F.round("total", 4))


@query(
    "stm_3",
    """
SELECT event_id, user_id, CAST(COALESCE(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER
         (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_sum
FROM events""",
)
def stm_3(t):
    # The table arrives in three stretches of time, the first one late; the stream is taken up again for each.
    source, target, checkpoint = (scratch_path(t.spark) for _ in range(3))
    rows = t.events.select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    stretch = F.floor(F.dayofmonth("ts") / 11)
    for number in (1, 0, 2):
        rows.where(stretch == number).write.mode("append").parquet(source)
        stream = weekly.read_new_files(t.spark, source, rows.schema)
        weekly.prior_sums(stream, ["user_id"], ["ts", "event_id"], "cents", target, checkpoint, buckets=16)
    return weekly.running_rows(t.spark, target).select("event_id", "user_id", "prior_sum")


# The watermark form on the same backlog in order of time: nothing is late, and the state ends as the batch does.
@query(
    "stm_2_watermark",
    """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS rows, ROUND(SUM(value), 4) AS total,
       CAST(0 AS BIGINT) AS dropped_groups
FROM events GROUP BY 1, 2""",
)
def stm_2_watermark(t):
    source, target, checkpoint = (scratch_path(t.spark) for _ in range(3))
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    stretch = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4))
    dropped = 0
    for number in range(5):
        rows.where(stretch == number).write.mode("append").parquet(source)
        stream = weekly.read_new_files(t.spark, source, rows.schema)
        dropped += weekly.keep_updates(weekly.weekly_totals(stream, "ts", ["event_type"], "value", delay="2 days"), target, checkpoint)
    totals = weekly.latest(t.spark, target, ["week_start", "event_type"])
    return totals.withColumns({"total": F.round("total", 4), "dropped_groups": F.lit(dropped).cast("bigint")})
