"""Event time, the watermark and routing of late rows.

``watermark = greatest event time among earlier rows - delay``. *Earlier* means an earlier
micro-batch (:func:`route_late`) or, record by record, a lower arrival number
(:func:`route_late_per_record`). A row is late when its event time lies before the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY, WATERMARK_DELAY_MS
from sluicegate.functions.times import plus_ms

#: Greatest number of arrivals one task orders at once, see :func:`prior_max`.
SEGMENT = 1_000_000
#: Greatest number of segment summaries one task orders at once.
SEGMENTS_PER_GROUP = 10_000

ON_TIME = "ON_TIME"
LATE = "LATE"


def assign_event_time(events: DataFrame, fallback: str | None = None) -> DataFrame:
    """Add ``event_ts``, epoch milliseconds of the event time, or of the record's own time where it is null."""
    time = F.col("event_time") if fallback is None else F.coalesce("event_time", fallback)
    return events.withColumn("event_ts", F.unix_millis(time))


def bounded_watermark(greatest_event_time: Column, delay_ms: int = WATERMARK_DELAY_MS) -> Column:
    return plus_ms(greatest_event_time, -delay_ms)


def _before(partition: list[str], order: str) -> Window:
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def prior_max(
    rows: DataFrame,
    order: str,
    value: str,
    result: str,
    segment: int = SEGMENT,
    group: int = SEGMENTS_PER_GROUP,
) -> DataFrame:
    """Add the maximum of ``value`` over all rows with a lower ``order``, a unique whole number.

    A running maximum over everything would run in one task. Here the order numbers are cut
    into segments of fixed width: each segment is ordered on its own (at most ``segment``
    rows, whatever the data looks like), and the maxima of the segments, of groups of segments and so on are carried forward,
    until a unit is so wide that all whole numbers make up a few of them, however far apart they lie.
    """
    rows = rows.withColumn("_segment", F.call_function("div", F.col(order), F.lit(segment)))
    maxima = rows.groupBy("_segment").agg(F.max(value).alias("_max"))
    levels = 0
    while segment * group**levels < 2**62:
        levels += 1
    earlier = _carried(maxima, "_segment", group, levels).withColumnRenamed("_carried", "_earlier")
    in_segment = F.max(value).over(_before(["_segment"], order))
    return (
        rows.join(earlier, "_segment", "left")
        .withColumn(result, F.greatest(in_segment, "_earlier"))
        .drop("_segment", "_earlier")
    )


def _carried(maxima: DataFrame, unit: str, group: int, levels: int) -> DataFrame:
    """(unit, _carried): the maximum over all units before; only the last level, of a few rows, is one window."""
    if not levels:
        return maxima.select(unit, F.max("_max").over(_before([], unit)).alias("_carried"))
    upper = f"_group{levels}"
    grouped = maxima.withColumn(upper, F.call_function("div", F.col(unit), F.lit(group)))
    above = _carried(grouped.groupBy(upper).agg(F.max("_max").alias("_max")), upper, group, levels - 1)
    inside = grouped.withColumn("_inside", F.max("_max").over(_before([upper], unit)))
    return inside.join(above, upper).select(unit, F.greatest("_inside", "_carried").alias("_carried"))


def late_diagnostics(events: DataFrame, watermark: str = "watermark") -> DataFrame:
    """Add how late a row is and the watermark that decided it; both NULL for rows on time."""
    is_late = F.coalesce(F.col("event_time") < F.col(watermark), F.lit(False))
    late_ms = F.unix_millis(watermark) - F.unix_millis("event_time")
    return events.withColumns(
        {
            "route": F.when(is_late, LATE).otherwise(ON_TIME),
            "late_ms": F.when(is_late, late_ms),
            "source_watermark": F.when(is_late, F.col(watermark)),
        }
    )


def route_late(events: DataFrame, batch: str = "batch_id", delay_ms: int = WATERMARK_DELAY_MS) -> DataFrame:
    """Route rows by the watermark their micro-batch started with.

    Only one row per batch is ordered. The result is joined back on the batch, without a
    hint: small tables of batches are broadcast by their measured size, others shuffled, where
    a batch holding much of the data is split by the adaptive skew join.
    """
    batches = events.groupBy(batch).agg(F.max("event_time").alias("_batch_max"))
    marks = prior_max(batches, batch, "_batch_max", "_greatest").select(
        batch, bounded_watermark(F.col("_greatest"), delay_ms).alias("watermark")
    )
    return late_diagnostics(events.join(marks, batch, "left")).drop("watermark")


def route_late_per_record(
    events: DataFrame, arrival: str = "arrival", delay_ms: int = WATERMARK_DELAY_MS, segment: int = SEGMENT
) -> DataFrame:
    """Route rows by the watermark all earlier arrivals left; arrival numbers must be unique."""
    marked = prior_max(events, arrival, "event_time", "_greatest", segment)
    return late_diagnostics(marked.withColumn("watermark", bounded_watermark(F.col("_greatest"), delay_ms))).drop(
        "watermark", "_greatest"
    )


def on_time_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == ON_TIME).drop("route", "late_ms", "source_watermark")


def late_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == LATE).drop("route")


def late_counter(late: DataFrame) -> DataFrame:
    """Late rows per de-duplication key."""
    return late.groupBy(*DEDUP_KEY).agg(F.count(F.lit(1)).alias("late_cnt"))
