"""Lake upkeep: file health, compaction, expiry. Plans are DataFrames; deleting is a separate call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.functions.times import plus_ms
from sluicegate.operators.cdc import latest_per_key
from sluicegate.plans.reports import Clock, as_instant
from sluicegate.schema import LAKE_COLUMNS
from sluicegate.sinks.files import delete_in_tasks
from sluicegate.sinks.lake import commit
from sluicegate.sources import lake

_MB = 1024 * 1024
#: Files one task packs into bins at once.
FILES_PER_SLICE = 10_000
#: Files of unknown commits are left alone for so long, as their writers may still be running.
ORPHAN_DAYS = 3


def files_per_partition(files: DataFrame, last: int = C.REPORT_PARTITIONS) -> DataFrame:
    size = F.col("file_size_in_bytes")
    return (
        files.groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("total_files"),
            (F.sum(size) / _MB / 1024).alias("total_gb"),
            (F.min(size) / _MB).alias("min_mb"),
            (F.max(size) / _MB).alias("max_mb"),
            (F.avg(size) / _MB).alias("avg_mb"),
        )
        .orderBy(F.col("dt").desc())
        .limit(last)
    )


def partition_distribution(rows: DataFrame, last: int = C.REPORT_PARTITIONS, approximate: bool = False) -> DataFrame:
    """Rows, users and devices per day.

    The exact form counts each (day, user) and (day, device) pair once before adding up, so a
    day with most of the data is still spread over all tasks.
    """
    if approximate:
        distinct = F.approx_count_distinct
        daily = rows.groupBy("dt").agg(
            F.count(F.lit(1)).alias("rows"), distinct("user_id").alias("users"), distinct("device_id").alias("devices")
        )
    else:
        daily = rows.groupBy("dt").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("user_id").alias("users"),
            F.count_distinct("device_id").alias("devices"),
        )
    return daily.orderBy(F.col("dt").desc()).limit(last)


def plan_compaction(
    files: DataFrame,
    target_bytes: int = C.TARGET_FILE_BYTES,
    max_bytes: int = C.MAX_FILE_BYTES,
    min_input_files: int = C.MIN_INPUT_FILES,
    rewrite_all: bool = False,
    dt: str | None = None,
    files_per_slice: int = FILES_PER_SLICE,
) -> DataFrame:
    """Which files to rewrite together: one row per file with its day and bin.

    Small files of a day (all files with ``rewrite_all``, and any above ``max_bytes``) are
    laid end to end and cut every ``target_bytes``; bins of fewer than ``min_input_files`` are
    left alone unless they hold an oversized file. A day with very many files is packed in
    slices of bounded size, so no task sees more than about ``files_per_slice`` of them.
    """
    size = F.col("file_size_in_bytes")
    candidates = files if dt is None else files.where(F.col("dt") == F.lit(dt).cast("date"))
    if not rewrite_all:
        candidates = candidates.where((size < target_bytes) | (size > max_bytes))
    days = candidates.groupBy("dt").agg(F.count(F.lit(1)).alias("_day_files"))
    slices = F.ceil(F.col("_day_files") / files_per_slice)
    sliced = candidates.join(days, "dt").withColumn("slice", F.pmod(F.xxhash64("file_path"), slices))
    packed = Window.partitionBy("dt", "slice").orderBy("file_path").rowsBetween(Window.unboundedPreceding, 0)
    binned = sliced.withColumn("bin_id", F.call_function("div", F.sum(size).over(packed) - 1, F.lit(target_bytes)))
    one_bin = Window.partitionBy("dt", "slice", "bin_id")
    worthwhile = (F.count(F.lit(1)).over(one_bin) >= min_input_files) | (F.max(size).over(one_bin) > max_bytes)
    return binned.withColumn("_keep", worthwhile).where("_keep").select(*files.columns, "slice", "bin_id")


def compaction_groups(plan: DataFrame) -> DataFrame:
    return plan.groupBy("dt", "slice", "bin_id").agg(
        F.count(F.lit(1)).alias("input_files"), F.sum("file_size_in_bytes").alias("input_bytes")
    )


def compact_partitions(
    spark: SparkSession,
    root: str,
    commit_id: str,
    plan: DataFrame | None = None,
    target_bytes: int = C.TARGET_FILE_BYTES,
    resolve: bool = True,
    **plan_options,
) -> DataFrame:
    """Rewrite the commits that hold planned files; returns files and bytes before and after.

    Each day is written as ``ceil(bytes / target)`` files, rows dealt out by a hash of the
    whole key, so neither a hot user nor a hot day makes one task slow. With ``resolve``
    overtaken changes are dropped; it covers all commits of a day then, since a change may be
    overtaken by any of them.
    """
    live = lake.live_commits(lake.read_commits(spark, root))
    files = lake.lake_files(spark, lake.data_path(root)).join(live, ["dt", "commit_id"], "left_semi")
    before = file_totals(files, "before")
    planned = plan_compaction(files, target_bytes, **plan_options) if plan is None else plan
    on = ["dt"] if resolve else ["dt", "commit_id"]
    chosen = live.join(planned.select(*on).distinct(), on, "left_semi")
    sizes = files.join(chosen, ["dt", "commit_id"], "left_semi").groupBy("dt").agg(
        F.ceil(F.sum("file_size_in_bytes") / target_bytes).cast("int").alias("_files")
    )
    # One number per day: the first output partition of each day and the total.
    layout = [(row["dt"], row["_files"]) for row in sizes.orderBy("dt").toLocalIterator()]
    if layout:
        first, offsets = 0, []
        for day, count in layout:
            offsets.append((day, first, count))
            first += count
        placing = spark.createDataFrame(offsets, "dt date, _first int, _files int")
        rows = lake.read_stored(spark, root, chosen).select(*LAKE_COLUMNS)
        if resolve:
            rows = latest_per_key(rows, arrival="etl_time", key=("dt", *C.DEDUP_KEY))
        share = F.pmod(F.xxhash64(*C.DEDUP_KEY), F.col("_files")).cast("int")
        placed = rows.join(placing, "dt").withColumn("_target", F.col("_first") + share)
        placed = placed.repartitionById(first, "_target").select(*LAKE_COLUMNS)
        commit(spark, root, placed, commit_id, "replace", chosen, distributed=True)
    return compaction_report(before, file_totals(lake.live_lake_files(spark, root), "after"))


def file_totals(files: DataFrame, suffix: str) -> DataFrame:
    """One row, computed now: a later listing would already see the rewritten files."""
    total = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)).alias("b")).first()
    return files.sparkSession.createDataFrame(
        [(total["n"], total["b"])], f"files_{suffix} bigint, bytes_{suffix} bigint"
    )


def compaction_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files and megabytes before and after, and by how many percent the files went down."""
    kept = F.col("files_after") / F.nullif(F.col("files_before").cast("double"), F.lit(0.0))
    both = before.unionByName(after, allowMissingColumns=True)
    totals = both.agg(*(F.max(name).alias(name) for name in both.columns))
    return totals.select(
        "files_before",
        F.floor(F.col("bytes_before") / _MB).alias("mb_before"),
        "files_after",
        F.floor(F.col("bytes_after") / _MB).alias("mb_after"),
        F.coalesce(F.round((1 - kept) * 100, 1), F.lit(0.0)).alias("reduction_pct"),
    )


def expire_snapshots(
    snapshots: DataFrame,
    as_of: Clock = None,
    older_than: Clock = None,
    retention_days: int = C.SNAPSHOT_RETENTION_DAYS,
    retain_last: int = C.SNAPSHOT_RETAIN_LAST,
) -> DataFrame:
    """Commits older than the retention, except the newest few."""
    bound: Column = (
        plus_ms(as_instant(as_of), -retention_days * 86_400_000) if older_than is None else as_instant(older_than)
    )
    newest = snapshots.orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc()).limit(retain_last)
    old = snapshots.where(F.col("committed_at") < bound)
    return old.join(newest.select("snapshot_id"), "snapshot_id", "left_anti")


def expired_files(spark: SparkSession, root: str, as_of: Clock = None, older_than: Clock = None) -> DataFrame:
    """Data files of replaced commits that no kept snapshot needs: their replacement has expired too."""
    commits = lake.read_commits(spark, root)
    expired = expire_snapshots(lake.lake_snapshots(commits), as_of, older_than).select("snapshot_id")
    replaced = (
        commits.join(expired, "snapshot_id", "left_semi").select("dt", F.explode("replaced").alias("commit_id")).distinct()
    )
    files = lake.lake_files(spark, lake.data_path(root))
    return files.join(replaced, ["dt", "commit_id"], "left_semi")


def find_orphan_files(files: DataFrame, commits: DataFrame, older_than: Clock = None) -> DataFrame:
    """Data files in folders no commit speaks of, such as those of a write that never finished.

    Files of running writers have no commit yet, so only files older than ``older_than`` count, three days by default.
    """
    bound = plus_ms(F.current_timestamp(), -ORPHAN_DAYS * 86_400_000) if older_than is None else as_instant(older_than)
    orphans = files.join(commits.select("dt", "commit_id").distinct(), ["dt", "commit_id"], "left_anti")
    return orphans.where(F.col("modified_at") < bound)


def delete_files(files: DataFrame) -> int:
    """Delete the listed files in tasks; how many were there. Run it only on a plan you have looked at."""
    return delete_in_tasks(files)
