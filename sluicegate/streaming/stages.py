"""Log ingestion as two streams: clean and route late rows, then remove repeats.

Spark drops rows behind its own watermark without a trace and moves that watermark one batch
late, so it cannot tell late rows apart. The first stream compares with a stored mark of its
own and is free of state; the second only sees rows on time and uses the watermark to forget
keys. Its delay is far above the lateness allowed in the first stream, so nothing is lost there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluicegate.constants import DEDUP_KEY, JDBC_BATCH_INTERVAL, WATERMARK_DELAY_MS
from sluicegate.operators.clean import clean_events, clean_rows, dirty_records
from sluicegate.operators.dedup import dedup_first_seen, join_on
from sluicegate.operators.late import bounded_watermark, late_diagnostics, late_rows, on_time_rows
from sluicegate.schema import EVENT, nullable
from sluicegate.session import use_state_backend
from sluicegate.sinks.jdbc import late_table_rows, main_table_rows
from sluicegate.sinks.tables import write_batch, write_dirty
from sluicegate.streaming import live
from sluicegate.streaming.jobs import observe_quality
from sluicegate.streaming.marks import query_id, read_mark, read_position, write_mark, write_position

BatchWriter = Callable[[DataFrame, int], None]

_SHUFFLE = "spark.sql.shuffle.partitions"
#: Rows of a stream, over its whole life, that one partition of its state holds.
ROWS_PER_TASK = 1_000_000


def enough_tasks(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for a stream of about so many rows: two a core, more where a partition would hold too many, never above the setting.

    Every partition costs a store and a file in each batch, even where a batch has nothing for it.
    """
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return max(1, min(wanted, int(spark.conf.get(_SHUFFLE))))


@contextmanager
def shuffle_tasks(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Start streams with so many shuffle partitions; each keeps the number its state was first laid out with."""
    before = spark.conf.get(_SHUFFLE)
    spark.conf.set(_SHUFFLE, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, before)


def parquet_writer(path: str) -> BatchWriter:
    return lambda rows, batch_id: write_batch(rows, path, batch_id)


def start(
    stream: DataFrame,
    checkpoint: str,
    each_batch: BatchWriter,
    trigger: str | None = JDBC_BATCH_INTERVAL,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a stream; without a trigger interval it reads what is there and ends."""
    writer = stream.writeStream.foreachBatch(each_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def route_batch(
    root: str,
    write_late: BatchWriter,
    arrival: str | tuple[str, ...] = "arrival",
    delay_ms: int = WATERMARK_DELAY_MS,
    quality: bool = False,
) -> BatchWriter:
    """Batch function of the first stream: dirty, late and on-time rows to their tables, then the mark.

    The mark is written last; a batch that has one, from this stream, is done. Repeats inside the batch are
    removed here, where map tasks can drop them before any shuffle.
    """
    order = (arrival,) if isinstance(arrival, str) else arrival

    def each_batch(tagged: DataFrame, batch_id: int) -> None:
        spark = tagged.sparkSession
        owner = query_id(spark, f"{root}/checkpoints/clean")
        done, _ = read_mark(spark, f"{root}/marks", batch_id, owner)
        if done:
            return
        _, greatest = read_mark(spark, f"{root}/marks", batch_id - 1, owner)
        tagged = tagged.persist()
        try:
            clean = clean_rows(tagged, order)
            mark = F.lit(greatest).cast("timestamp")
            routed = late_diagnostics(clean.withColumn("watermark", bounded_watermark(mark, delay_ms)))
            write_dirty(dirty_records(tagged, order), f"{root}/dirty", batch_id)
            write_late(late_table_rows(late_rows(routed)), batch_id)
            on_time = dedup_first_seen(on_time_rows(routed), order).drop("watermark")
            write_batch(on_time, f"{root}/on_time", batch_id, rebalance=False, whole=True)
            if quality:
                write_batch(live.status_feed(tagged, routed), f"{root}/status", batch_id, rebalance=False, whole=True)
            newest = clean.agg(F.max("event_time").alias("newest")).first()["newest"]
            known = [time for time in (greatest, newest) if time is not None]
            write_mark(spark, f"{root}/marks", batch_id, max(known, default=None), owner)
        finally:
            tagged.unpersist()

    return each_batch


def start_cleaning(
    logs: DataFrame,
    root: str,
    write_late: BatchWriter | None = None,
    arrival: str | tuple[str, ...] = "arrival",
    trigger: str | None = JDBC_BATCH_INTERVAL,
    delay_ms: int = WATERMARK_DELAY_MS,
    quality: bool = False,
    **clean_options,
) -> StreamingQuery:
    """First stream: clean, split off dirty and late rows, append rows on time below ``root``.

    The rules run in the streaming plan, where the clock is the trigger's and a repeated batch
    gives the same verdicts. With ``quality`` it observes its counters and feeds :func:`~sluicegate.streaming.live.start_quality`,
    for which ``arrival`` has to name ``arrived_at``.
    """
    late_writer = write_late or parquet_writer(f"{root}/late")
    tagged = clean_events(logs, **clean_options)
    return start(
        observe_quality(tagged) if quality else tagged,
        f"{root}/checkpoints/clean",
        route_batch(root, late_writer, arrival, delay_ms, quality),
        trigger,
        "clean",
    )


def on_time_stream(
    spark: SparkSession,
    root: str,
    arrival: dict[str, str] | None = None,
    archive: str | None = None,
) -> DataFrame:
    """What the first stream appends, as a stream, in whole batches.

    A part of a batch would move Spark's watermark past the rest of it, so the number of files is not limited and a
    batch's folder appears in one step.

    Files read are moved to ``archive`` where given, so that a long-running stream lists few folders.
    """
    order = ", ".join(f"{name} {kind}" for name, kind in (arrival or {"arrival": "bigint"}).items())
    schema = T.StructType([*T.StructType.fromDDL(order).fields, *nullable(EVENT).fields])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/on_time/batch_id=-1")
    reader = spark.readStream.schema(schema.add("batch_id", T.LongType())).option("ignoreMissingFiles", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(f"{root}/on_time")


def drop_repeats(events: DataFrame, keep_for: str = "1 hour") -> DataFrame:
    """Keep the first row of each key across batches; keys are forgotten ``keep_for`` behind the newest event."""
    return events.withWatermark("event_time", keep_for).dropDuplicates(list(DEDUP_KEY))


def start_dedup(
    spark: SparkSession,
    root: str,
    write_main: BatchWriter | None = None,
    arrival: dict[str, str] | None = None,
    trigger: str | None = JDBC_BATCH_INTERVAL,
    keep_for: str = "1 hour",
    archive: str | None = None,
    quality: bool = False,
) -> StreamingQuery:
    """Second stream: rows on time, once each, to the main table.

    Where it reads several batches of the first stream at once, Spark's state only says which keys are new. The row that
    stays is then looked up among those batches: the one of the lowest arrival.
    """
    use_state_backend(spark)
    writer = write_main or parquet_writer(f"{root}/main")
    stream = on_time_stream(spark, root, arrival, archive)
    order = tuple(arrival or {"arrival": "bigint"})

    def each_batch(new: DataFrame, batch_id: int) -> None:
        session = new.sparkSession
        new = new.persist()
        try:
            low, high = new.agg(F.min("batch_id"), F.max("batch_id")).first()
            _, start_at = read_position(session, f"{root}/positions", batch_id - 1)
            rows = new
            if low is not None and (low != high or start_at is None or high > start_at + 1):
                stored = session.read.schema(stream.schema).option("basePath", f"{root}/on_time").option("ignoreMissingFiles", "true")
                recent = stored.parquet(f"{root}/on_time").where(F.col("batch_id") >= (-1 if start_at is None else start_at))
                rows = dedup_first_seen(join_on(recent, new.select(*DEDUP_KEY), DEDUP_KEY, "left_semi"), ("batch_id", *order))
            writer(main_table_rows(rows), batch_id)
            if quality:
                write_batch(live.kept_feed(rows), f"{root}/kept", batch_id, rebalance=False, whole=True)
            write_position(session, f"{root}/positions", batch_id, start_at if high is None else high)
        finally:
            new.unpersist()

    return start(drop_repeats(stream, keep_for), f"{root}/checkpoints/dedup", each_batch, trigger, "dedup")


def check_nothing_dropped(query: StreamingQuery) -> None:
    """Raise when Spark's own watermark has dropped rows that the first stream found on time."""
    dropped = sum(int(state.numRowsDroppedByWatermark) for progress in query.recentProgress for state in progress.stateOperators)
    if dropped:
        raise RuntimeError(f"{dropped} rows on time were dropped by the second stream's watermark")


def start_plain_ingestion(
    logs: DataFrame,
    root: str,
    write_main: BatchWriter | None = None,
    trigger: str | None = JDBC_BATCH_INTERVAL,
    **clean_options,
) -> StreamingQuery:
    """The simplest job: clean rows to the main table, dirty rows to quarantine, nothing else."""
    writer = write_main or parquet_writer(f"{root}/main")

    def each_batch(tagged: DataFrame, batch_id: int) -> None:
        tagged = tagged.persist()
        try:
            write_dirty(dirty_records(tagged), f"{root}/dirty", batch_id)
            writer(main_table_rows(clean_rows(tagged)), batch_id)
        finally:
            tagged.unpersist()

    return start(clean_events(logs, **clean_options), f"{root}/checkpoints/plain", each_batch, trigger, "plain")
