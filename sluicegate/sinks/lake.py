"""Writing the dated lake table: appends, upserts and commits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.constants import BLOOM_COLUMNS, DEDUP_KEY
from sluicegate.operators.cdc import latest_per_key, to_lake_row
from sluicegate.schema import LAKE_COLUMNS
from sluicegate.sources import lake
from sluicegate.sources.tables import stage

#: Users are hashed into this many slices per day before files are written.
USER_SLICES = 64


def bloom_filter_columns(columns: tuple[str, ...] = BLOOM_COLUMNS) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}


def distribute(rows: DataFrame) -> DataFrame:
    """Group rows by day and user slice for writing.

    As a rebalance, small slices share a file and a slice swollen by one very active user is
    split over several tasks, by sizes measured at run time.
    """
    user_slice = F.pmod(F.xxhash64("user_id"), F.lit(USER_SLICES))
    sliced = rows.withColumn("_user_slice", user_slice)
    return sliced.hint("rebalance", "dt", "_user_slice").drop("_user_slice")


def commit(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    commit_id: str,
    operation: str = "append",
    replaced: DataFrame | None = None,
    distributed: bool = False,
    max_records_per_file: int = 0,
) -> bool:
    """Write rows into folders of this commit, then make them visible; False when it was done before.

    The commit table is written last and in one file, so readers see all of a commit or
    nothing. What a failed attempt left behind stays unseen until it is removed as orphaned. ``replaced`` holds the
    ``dt, commit_id`` folders the new rows stand in for.
    """
    if lake.is_committed(spark, root, commit_id):
        return False
    # Folders of an attempt of its own: what a failed or refused attempt left behind can never become visible.
    attempt = uuid.uuid4().hex
    folder = f"{commit_id}~{attempt}"
    placed = rows if distributed else distribute(rows)
    writer = (
        placed.withColumn("commit_id", F.lit(folder))
        .sortWithinPartitions("dt", "commit_id", "user_id", "event_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .options(**bloom_filter_columns())
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy("dt", "commit_id").parquet(lake.data_path(root))
    if replaced is not None:
        # Written out, as Spark takes two listings of one folder in one plan to be the same.
        replaced = stage(replaced, "replaced")
        live = lake.live_commits(lake.read_commits(spark, root))
        if not replaced.join(live, ["dt", "commit_id"], "left_anti").isEmpty():
            raise RuntimeError(f"{commit_id}: another commit has rewritten the same days; start again from its result")
    log = _commit_rows(spark, root, folder, operation, replaced).withColumn("attempt", F.lit(attempt))
    log.coalesce(1).write.mode("overwrite").parquet(f"{lake.commits_path(root)}/commit_id={commit_id}")
    return True


def _commit_rows(
    spark: SparkSession, root: str, commit_id: str, operation: str, replaced: DataFrame | None
) -> DataFrame:
    """One row per day this commit wrote or emptied, from the files it wrote."""
    written = f"{lake.data_path(root)}/dt=*/commit_id={commit_id}"
    try:
        base = {"basePath": lake.data_path(root)}
        files = (
            spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", **base).load(written)
            .groupBy(F.col("dt").cast("date").alias("dt"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        )
        records = spark.read.options(**base).parquet(written).groupBy(F.col("dt").cast("date").alias("dt"))
        days = files.join(records.agg(F.count(F.lit(1)).alias("records")), "dt", "full_outer")
    except lake.AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        days = spark.createDataFrame([], "dt date, files bigint, bytes bigint, records bigint")
    if replaced is None:
        gone = spark.createDataFrame([], "dt date, replaced array<string>")
    else:
        gone = replaced.groupBy("dt").agg(F.collect_set("commit_id").alias("replaced"))
    return days.join(gone, "dt", "full_outer").select(
        F.xxhash64(F.lit(commit_id)).alias("snapshot_id"),
        F.current_timestamp().alias("committed_at"),
        F.lit(operation).alias("operation"),
        "dt",
        F.coalesce("replaced", F.array().cast("array<string>")).alias("replaced"),
        F.create_map(
            F.lit("added-data-files"), F.coalesce("files", F.lit(0)).cast("string"),
            F.lit("added-files-size"), F.coalesce("bytes", F.lit(0)).cast("string"),
            F.lit("added-records"), F.coalesce("records", F.lit(0)).cast("string"),
        ).alias("summary"),
    )


def write_lake(spark: SparkSession, root: str, rows: DataFrame, commit_id: str) -> bool:
    """Append a batch of lake rows."""
    return commit(spark, root, rows.select(*LAKE_COLUMNS), commit_id)


def append_changes(spark: SparkSession, root: str, changes: DataFrame, commit_id: str, arrival: str | tuple[str, ...]) -> bool:
    """Append the newest change per key; readers and compaction resolve them against older ones.

    The cheap way in for frequent small batches: nothing stored is read or rewritten.
    """
    return write_lake(spark, root, to_lake_row(latest_per_key(changes, arrival)), commit_id)


def upsert_lake(spark: SparkSession, root: str, changes: DataFrame, commit_id: str, arrival: str | tuple[str, ...]) -> bool:
    """Apply changes by rewriting the days they touch.

    Stored and new rows compete by source time, so a delayed old update cannot replace a newer
    one; deletes stay stored as tombstones for the same reason and are hidden by readers.
    """
    if lake.is_committed(spark, root, commit_id):
        return False
    incoming = to_lake_row(latest_per_key(changes, arrival))
    touched = incoming.select("dt").distinct()
    replaced = lake.live_commits(lake.read_commits(spark, root)).join(touched, "dt", "left_semi")
    stored = lake.read_stored(spark, root, replaced).select(*LAKE_COLUMNS)
    merged = latest_per_key(incoming.unionByName(stored), arrival="etl_time", key=("dt", *DEDUP_KEY))
    return commit(spark, root, merged, commit_id, "overwrite", replaced)
