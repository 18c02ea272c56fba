"""Reporting queries over the main, late and lake tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.functions.times import as_instant, plus_ms

Clock = str | dt.datetime | Column | None


def between_events(df: DataFrame, start: Clock, end: Clock) -> DataFrame:
    """Half-open event-time range, either bound by itself if the other is None; on a dated table the same range on ``dt`` prunes partitions."""
    dated = "dt" in df.columns
    if start is not None:
        low = as_instant(start)
        df = df.where(F.col("event_time") >= low)
        df = df.where(F.col("dt") >= F.to_date(low)) if dated else df
    if end is not None:
        high = as_instant(end)
        df = df.where(F.col("event_time") < high)
        # the last instant inside the range: midnight itself opens no further day
        df = df.where(F.col("dt") <= F.to_date(high - F.expr("INTERVAL 1 MICROSECOND"))) if dated else df
    return df


def hourly_event_count(events: DataFrame, start: Clock = None, end: Clock = None) -> DataFrame:
    events = between_events(events, start, end)
    # Truncating is cheap; only the few groups are formatted.
    hour = F.date_trunc("hour", "event_time").alias("_hour")
    return (
        events.groupBy(hour, "event_type")
        .agg(F.count(F.lit(1)).alias("event_cnt"))
        .select(F.date_format("_hour", "yyyy-MM-dd HH").alias("hour_slot"), "event_type", "event_cnt")
        .orderBy("hour_slot", "event_type")
    )


def user_trajectory(events: DataFrame, user_id: str, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """One user's events in time order."""
    return (
        events.where(F.col("user_id") == user_id)
        .select("event_time", "event_type", "page", "product_id", "duration_ms", *tie_break)
        .orderBy("event_time", *tie_break)
    )


def cleaned_count(main: DataFrame) -> DataFrame:
    return main.agg(F.count(F.lit(1)).alias("ods_cleaned_cnt"))


def dirty_rate(tagged: DataFrame) -> DataFrame:
    """Raw, clean and dirty counts in one pass, with the dirty share in percent."""
    is_dirty = F.col("verdict") == "DIRTY"
    raw_count = F.count(F.lit(1))
    return tagged.agg(
        raw_count.alias("raw_cnt"),
        F.count_if(~is_dirty).alias("cleaned_cnt"),
        F.count_if(is_dirty).alias("dirty_cnt"),
        _percent(F.count_if(is_dirty), raw_count).alias("dirty_pct"),
    )


def dirty_by_reason(tagged: DataFrame) -> DataFrame:
    return (
        tagged.where(F.col("verdict") == "DIRTY")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("dirty_cnt"))
        .orderBy("reason")
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), 2)


def late_rate(main: DataFrame, late: DataFrame) -> DataFrame:
    """Late rows against rows in the main table, counted in one pass over both."""
    both = main.select(F.lit(False).alias("is_late")).union(late.select(F.lit(True)))
    counts = both.agg(F.count_if(~F.col("is_late")).alias("main_cnt"), F.count_if("is_late").alias("late_cnt"))
    return counts.select("main_cnt", "late_cnt", _percent(F.col("late_cnt"), F.col("main_cnt")).alias("late_pct"))


def late_bucket(late_ms: Column) -> Column:
    """Name of the lateness class; an unknown lateness falls into the last one."""
    first, *others = C.LATE_BUCKETS
    label = F.when(late_ms < first[0], first[1])
    for bound, name in others:
        label = label.when(late_ms < bound, name)
    return label.otherwise(C.LATE_BUCKET_REST)


def late_histogram(late: DataFrame, as_of: Clock = None, last_ms: int = 3_600_000) -> DataFrame:
    """Rows loaded within the last hour by lateness class, shortest lateness first."""
    recent = late.where(F.col("etl_time") >= plus_ms(as_instant(as_of), -last_ms))
    return (
        recent.groupBy(late_bucket(F.col("late_ms")).alias("late_bucket"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.round(F.avg("late_ms") / 1000, 2).alias("avg_late_s"),
            F.min("late_ms").alias("_shortest"),
        )
        .orderBy("_shortest")
        .drop("_shortest")
    )


def late_rate_alert(
    main: DataFrame, late: DataFrame, bucket_seconds: int = 3600, sustained_buckets: int = 3
) -> DataFrame:
    """Late rate per time bucket with the advice it leads to.

    Over 2 percent: widen the watermark delay. Over 5 percent in each of the last
    ``sustained_buckets`` buckets: look into clocks and transport.
    """

    def counts(df: DataFrame, name: str) -> DataFrame:
        start = F.window("event_time", f"{bucket_seconds} seconds")["start"].alias("bucket_start")
        return df.groupBy(start).agg(F.count(F.lit(1)).alias(name))

    rates = (
        counts(main, "main_cnt")
        .join(counts(late, "late_cnt"), "bucket_start", "full_outer")
        .na.fill(0, ["main_cnt", "late_cnt"])
        .withColumn("late_pct", _percent(F.col("late_cnt"), F.col("main_cnt")))
    )
    # A bucket counts for itself and for the following ones that look back on it.
    ahead = rates.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(sustained_buckets - 1))))
    own = F.when(F.col("_ahead") == 0, F.struct("main_cnt", "late_cnt", "late_pct"))
    judged = (
        ahead.groupBy(plus_ms(F.col("bucket_start"), F.col("_ahead") * bucket_seconds * 1000).alias("bucket_start"))
        .agg(
            F.max(own).alias("_own"),
            F.count(F.lit(1)).alias("_buckets"),
            F.min(F.coalesce("late_pct", F.lit(100.0))).alias("_lowest_pct"),
        )
        .where(F.col("_own").isNotNull())
    )
    sustained = (F.col("_buckets") == sustained_buckets) & (F.col("_lowest_pct") > C.LATE_PCT_INVESTIGATE)
    advice = (
        F.when(sustained, "INVESTIGATE")
        .when(F.col("_own.late_pct") > C.LATE_PCT_WIDEN, "WIDEN_WATERMARK")
        .otherwise("OK")
    )
    return judged.select("bucket_start", "_own.*", advice.alias("advice")).orderBy("bucket_start")
