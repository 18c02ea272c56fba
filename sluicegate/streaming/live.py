"""Live figures: quality per time bucket, late rows per key, counters of every batch, and unions of sources that may fall idle."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sluicegate.constants import DEDUP_KEY, JDBC_BATCH_INTERVAL
from sluicegate.operators.late import LATE, ON_TIME
from sluicegate.schema import LATE as LATE_TABLE
from sluicegate.schema import nullable
from sluicegate.session import use_state_backend
from sluicegate.sinks.tables import write_batch
from sluicegate.streaming import stages

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"
_FEED = "seen timestamp, status string, reason string, cnt bigint, batch_id bigint"


def union_sources(spark: SparkSession, sources: list[DataFrame], time: str, delay: str, wait_for_idle: bool = False) -> DataFrame:
    """One stream out of several, each with a watermark of its own.

    By default the fastest source moves time on, so one that has fallen idle holds nothing back, and its rows may be late when it
    wakes; with ``wait_for_idle`` the slowest does, and results wait for it. Spark fixes the choice when a query first starts.
    """
    spark.conf.set(POLICY, "min" if wait_for_idle else "max")
    first, *rest = (source.withWatermark(time, delay) for source in sources)
    for source in rest:
        first = first.unionByName(source)
    return first


def status_feed(tagged: DataFrame, routed: DataFrame) -> DataFrame:
    """Messages of a batch per second of arrival, status and reason; clean rows on time count whether or not they repeat."""
    status = F.when(F.col("route") == LATE, LATE).otherwise(ON_TIME).alias("status")
    dirty = tagged.where(F.col("verdict") == "DIRTY").select("arrived_at", F.lit("DIRTY").alias("status"), "reason")
    return _by_second(dirty.unionByName(routed.select("arrived_at", status, F.lit(None).cast("string").alias("reason"))))


def kept_feed(rows: DataFrame) -> DataFrame:
    """Rows of a batch that the main table took, per second of arrival."""
    return _by_second(rows.select("arrived_at", F.lit("CLEAN").alias("status"), F.lit(None).cast("string").alias("reason")))


def _by_second(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.date_trunc("second", "arrived_at").alias("seen"), "status", "reason").agg(F.count(F.lit(1)).alias("cnt"))


def _feed(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL(_FEED)
    spark.createDataFrame([], T.StructType(schema.fields[:-1])).write.mode("ignore").parquet(f"{path}/batch_id=-1")
    return spark.readStream.schema(schema).parquet(path)


def start_quality(
    spark: SparkSession, root: str, bucket: str = "1 minute", keep_for: str = "1 hour", trigger: str | None = JDBC_BATCH_INTERVAL
) -> StreamingQuery:
    """Keep the figures of :func:`read_quality` up to date, from what the cleaning and de-duplicating streams feed.

    A count per bucket, status and reason is held as state and given out again whenever it changes; buckets ``keep_for`` behind
    the slower of both feeds are forgotten and what comes for them later is left out. Both streams must be started with ``quality``.
    """
    use_state_backend(spark)
    feeds = [_feed(spark, f"{root}/{name}") for name in ("status", "kept")]
    stream = union_sources(spark, feeds, "seen", keep_for, wait_for_idle=True)
    counts = stream.groupBy(F.window("seen", bucket).alias("bucket"), "status", "reason").agg(F.sum("cnt").alias("cnt"))
    changed = counts.select(F.col("bucket.start").alias("bucket_start"), "status", "reason", "cnt")
    writer = lambda rows, batch_id: write_batch(rows, f"{root}/quality", batch_id, rebalance=False)
    return stages.start(changed, f"{root}/checkpoints/quality", writer, trigger, "quality", mode="update")


def read_quality(spark: SparkSession, root: str) -> DataFrame:
    """The newest figures, as :func:`~sluicegate.plans.quality.quality_monitor` gives them for a batch."""
    stored = spark.read.schema("bucket_start timestamp, status string, reason string, cnt bigint, batch_id bigint").parquet(f"{root}/quality")
    newest = stored.groupBy("bucket_start", "status", "reason").agg(F.max_by("cnt", "batch_id").alias("cnt"))
    known = newest.where(F.col("status") != ON_TIME)
    rest = newest.where(F.col("status").isin(ON_TIME, "CLEAN")).select("bucket_start", F.when(F.col("status") == "CLEAN", -F.col("cnt")).otherwise(F.col("cnt")).alias("cnt"))
    repeats = rest.groupBy("bucket_start").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") > 0)
    nothing = F.lit(None).cast("string").alias("reason")
    return known.unionByName(repeats.select("bucket_start", F.lit("DUPLICATE").alias("status"), nothing, "cnt")).orderBy("bucket_start", "status", "reason")


def start_late_counter(
    spark: SparkSession, root: str, keep_for: str = "1 day", trigger: str | None = JDBC_BATCH_INTERVAL
) -> StreamingQuery:
    """Count late rows per key as they come; counters ``keep_for`` behind the newest late event are forgotten."""
    use_state_backend(spark)
    schema = T.StructType([*nullable(LATE_TABLE).fields, T.StructField("batch_id", T.LongType())])
    spark.createDataFrame([], nullable(LATE_TABLE)).write.mode("ignore").parquet(f"{root}/late/batch_id=-1")
    stream = spark.readStream.schema(schema).parquet(f"{root}/late").withWatermark("event_time", keep_for)
    counts = stream.groupBy(*DEDUP_KEY).agg(F.count(F.lit(1)).alias("late_cnt"))
    writer = lambda rows, batch_id: write_batch(rows, f"{root}/late_counts", batch_id, rebalance=False)
    return stages.start(counts, f"{root}/checkpoints/late_counter", writer, trigger, "late_counter", mode="update")


def read_late_counts(spark: SparkSession, root: str) -> DataFrame:
    stored = spark.read.parquet(f"{root}/late_counts")
    return stored.groupBy(*DEDUP_KEY).agg(F.max_by("late_cnt", "batch_id").alias("late_cnt"))


class CounterListener(StreamingQueryListener):
    """Stores what streams observe (:func:`~sluicegate.streaming.jobs.observe_quality`): a row per stream and batch.

    ``spark.streams.addListener(CounterListener(spark, path))`` before the stream starts. A batch that is reported again replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "quality") -> None:
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counters = progress.observedMetrics.get(self.name)
        if counters is None:
            return
        row = self.spark.createDataFrame([(progress.name, *counters)], f"stream string, {_COUNTERS}")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={progress.id}/batch_id={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_COUNTERS = "raw_cnt bigint, cleaned_cnt bigint, dirty_cnt bigint, newest_event_time timestamp"


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Stored counters of all streams and batches."""
    schema = f"stream string, {_COUNTERS}, query string, batch_id bigint"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
