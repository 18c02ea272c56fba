"""Data-quality figures over cleaned streams: what came in, what was rejected, late or repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY
from sluicegate.operators.dedup import dedup_first_seen
from sluicegate.operators.late import LATE
from sluicegate.plans.reports import hourly_event_count
from sluicegate.schema import EVENT_COLUMNS


def quality_monitor(
    tagged: DataFrame, routed: DataFrame, arrived_at: str, arrival: str = "arrival", bucket: str = "1 minute"
) -> DataFrame:
    """Messages per time bucket, status and reason.

    ``tagged`` supplies the dirty rows, ``routed`` the clean ones with their route. A clean row is LATE, CLEAN (the first
    on-time arrival of its key) or DUPLICATE. Repeats are only counted: rows on time less first ones, both from
    aggregates, so no row is joined with another.
    """
    start = F.window(arrived_at, bucket)["start"].alias("bucket_start")
    nothing = F.lit(None).cast("string").alias("reason")
    dirty = tagged.where(F.col("verdict") == "DIRTY").groupBy(start, F.lit("DIRTY").alias("status"), "reason")
    routes = routed.groupBy(start, F.when(F.col("route") == LATE, LATE).otherwise("ON_TIME").alias("status"))
    routes = routes.agg(F.count(F.lit(1)).alias("cnt"))
    first = dedup_first_seen(routed.where(F.col("route") != LATE), arrival).groupBy(start).agg(F.count(F.lit(1)).alias("cnt"))
    # firsts count as themselves and against the rows on time of their bucket
    repeats = routes.where(F.col("status") != LATE).select("bucket_start", "cnt").unionByName(first.select("bucket_start", (-F.col("cnt")).alias("cnt")))
    duplicates = repeats.groupBy("bucket_start").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") > 0)
    named = lambda df, status: df.select("bucket_start", F.lit(status).alias("status"), nothing, "cnt")
    return (
        dirty.agg(F.count(F.lit(1)).alias("cnt"))
        .unionByName(named(routes.where(F.col("status") == LATE), LATE))
        .unionByName(named(first, "CLEAN"))
        .unionByName(named(duplicates, "DUPLICATE"))
        .orderBy("bucket_start", "status", "reason")
    )


def ahead_of_clock(events: DataFrame, clock: str, bucket: str = "1 minute") -> DataFrame:
    """Clean rows dated after their arrival. They pass, but push the watermark and make others late."""
    ahead = F.unix_millis("event_time") - F.unix_millis(clock)
    return (
        events.where(ahead > 0)
        .groupBy(F.window(clock, bucket)["start"].alias("bucket_start"))
        .agg(F.count(F.lit(1)).alias("ahead_cnt"), F.max(ahead).alias("max_ahead_ms"))
        .orderBy("bucket_start")
    )


def late_backfill(main: DataFrame, late: DataFrame) -> DataFrame:
    """Main and late rows together, one row per key; a row already in the main table stays."""
    columns = [name for name in EVENT_COLUMNS]
    both = main.select(*columns, F.lit(0).alias("_from")).unionByName(late.select(*columns, F.lit(1).alias("_from")))
    tie_break = ["_from", *(name for name in columns if name not in DEDUP_KEY)]
    first = F.row_number().over(Window.partitionBy(*DEDUP_KEY).orderBy(*tie_break))
    return both.withColumn("_nth", first).where(F.col("_nth") == 1).drop("_nth", "_from")


def backfilled_hourly_count(main: DataFrame, late: DataFrame) -> DataFrame:
    return hourly_event_count(late_backfill(main, late))


def late_dirty_cross(late: DataFrame, dirty: DataFrame) -> DataFrame:
    """Late and dirty rows per user; dirty rows count under the user that could still be read."""
    late_count = late.groupBy("user_id").agg(F.count(F.lit(1)).alias("late_cnt"))
    dirty_count = (
        dirty.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("dirty_cnt"))
    )
    return (
        late_count.join(dirty_count, "user_id", "full_outer")
        .na.fill(0, ["late_cnt", "dirty_cnt"])
        .orderBy("user_id")
    )
