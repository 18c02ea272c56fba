"""The dated lake table: Parquet folders ``data/dt=../commit_id=..`` plus a small commit table.

Every write goes to folders of its own and becomes visible with one row per day in
``commits``. Rewrites name the commits they replace, so nothing that is read is overwritten,
and a lost executor or a repeated micro-batch leaves no half-written day behind.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.constants import DEDUP_KEY, REPORT_SNAPSHOTS
from sluicegate.operators.cdc import latest_per_key
from sluicegate.schema import LAKE, nullable

COMMIT = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("dt", T.DateType()),
        T.StructField("replaced", T.ArrayType(T.StringType())),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("attempt", T.StringType()),
        T.StructField("commit_id", T.StringType()),
    ]
)


def data_path(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def commits_path(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _read(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    try:
        return spark.read.schema(nullable(schema)).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], nullable(schema))


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit and day; ``commit_id`` names the folders of the attempt that was committed."""
    return _read(spark, commits_path(root), COMMIT).withColumn("commit_id", F.concat_ws("~", "commit_id", "attempt"))


def is_committed(spark: SparkSession, root: str, commit_id: str) -> bool:
    """Looks at that commit's own folder only."""
    path = f"{commits_path(root)}/commit_id={commit_id}"
    return not _read(spark, path, COMMIT, basePath=commits_path(root)).isEmpty()


def live_commits(commits: DataFrame) -> DataFrame:
    """``dt, commit_id`` of the folders that make up the table now."""
    replaced = commits.select("dt", F.explode("replaced").alias("commit_id"))
    return commits.select("dt", "commit_id").join(replaced, ["dt", "commit_id"], "left_anti")


def read_stored(spark: SparkSession, root: str, live: DataFrame | None = None) -> DataFrame:
    """All stored rows with their ``commit_id``, deletes and overtaken changes included."""
    live = live_commits(read_commits(spark, root)) if live is None else live
    stored = T.StructType([*LAKE.fields, T.StructField("commit_id", T.StringType())])
    return _read(spark, data_path(root), stored).join(live, ["dt", "commit_id"], "left_semi")


def read_lake(spark: SparkSession, root: str, resolve: bool = True, keep_tombstones: bool = False) -> DataFrame:
    """The lake table. ``resolve`` picks the newest change per key, needed where changes were appended.

    The day follows from the key; naming it lets a filter on ``dt`` reach the scan.
    """
    rows = read_stored(spark, root).drop("commit_id")
    if resolve:
        rows = latest_per_key(rows, arrival="etl_time", key=("dt", *DEDUP_KEY))
    return rows if keep_tombstones else rows.where(F.coalesce(F.col("op_type"), F.lit("I")) != "D")


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file below a folder with ``dt=..`` sub-folders; contents are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    extra = [name for name in ("commit_id",) if name in files.columns]
    return files.select(
        F.col("dt").cast("date").alias("dt"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size_in_bytes"),
        F.col("modificationTime").alias("modified_at"),
        *extra,
    )


def live_lake_files(spark: SparkSession, root: str) -> DataFrame:
    live = live_commits(read_commits(spark, root))
    return lake_files(spark, data_path(root)).join(live, ["dt", "commit_id"], "left_semi")


def lake_snapshots(commits: DataFrame) -> DataFrame:
    """One row per commit: id, time, operation and totals."""

    def total(name: str):
        return F.sum(F.col("summary")[name].cast("bigint")).cast("string")

    return commits.groupBy("snapshot_id", "committed_at", "operation").agg(
        F.create_map(
            F.lit("changed-partition-count"), F.count(F.lit(1)).cast("string"),
            F.lit("added-data-files"), total("added-data-files"),
            F.lit("added-files-size"), total("added-files-size"),
            F.lit("added-records"), total("added-records"),
        ).alias("summary")
    )


def recent_snapshots(snapshots: DataFrame, last: int = REPORT_SNAPSHOTS) -> DataFrame:
    return (
        snapshots.select("snapshot_id", "committed_at", "operation", "summary")
        .orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc())
        .limit(last)
    )
