"""Parquet targets written batch by batch, and the catalog tables over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.constants import BLOOM_COLUMNS, TARGET_FILE_BYTES
from sluicegate.schema import LAKE, LATE, MAIN
from sluicegate.session import delete_path, publish, work_dir


def write_batch(
    rows: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = (), rebalance: bool = True, whole: bool = False
) -> None:
    """Write a micro-batch into its own folder; repeating the batch replaces the folder.

    With ``whole`` the folder appears under its name in one step when all files are written (where the file system renames
    folders so), and repeating the batch leaves it: a stream that reads the folder sees all of a batch or nothing.

    ``rebalance`` gathers the rows of many tasks into files of a sensible size and splits what
    is too big; leave it out for rows that have just been shuffled.
    """
    placed = rows.hint("rebalance", *partition_by) if rebalance else rows
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if whole:
        writer.parquet(f"{path}/.writing-{batch_id}")
        publish(rows.sparkSession, f"{path}/.writing-{batch_id}", f"{path}/batch_id={batch_id}")
    else:
        writer.parquet(f"{path}/batch_id={batch_id}")


def write_clustered(
    rows: DataFrame,
    path: str,
    by: tuple[str, ...] = ("user_id", "event_time"),
    target_bytes: int = TARGET_FILE_BYTES,
    row_group_bytes: int | None = None,
) -> int:
    """Write a dated table in which neighbouring values share files of about ``target_bytes``; returns the number of ranges.

    Rows are range-partitioned by day and ``by``, so a file, and a row group in it, holds a narrow range of users: a filter on a
    user skips the others by their minima and maxima, and the rest by Bloom filters. A user with more rows than a
    file holds goes on in the next. The number of ranges comes from the rows' size as Parquet, for which they are staged.
    """
    spark = rows.sparkSession
    aside = work_dir(spark, "unclustered")
    rows.write.option("compression", "zstd").parquet(aside)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(aside)
    size = files.agg(F.sum("length")).first()[0] or 0
    staged = spark.read.schema(rows.schema).parquet(aside)
    ranges = max(1, -(-size // target_bytes))
    placed = staged.repartitionByRange(ranges, "dt", *by).sortWithinPartitions("dt", *by)
    writer = placed.write.partitionBy("dt").option("compression", "zstd").options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_COLUMNS})
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    delete_path(spark, aside)
    return ranges


def write_dirty(dirty: DataFrame, path: str, batch_id: int) -> None:
    """Quarantine table: rejected rows below a folder per reason."""
    write_batch(dirty, path, batch_id, partition_by=("reason",))


def _columns(schema: T.StructType) -> str:
    return ", ".join(
        f"{field.name} {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}" for field in schema.fields
    )


def create_tables(
    spark: SparkSession,
    database: str,
    main: str = "user_action_main",
    late: str = "user_action_late",
    lake: str = "user_action_lake",
) -> None:
    """Create the database and the main, late and dated lake tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema, partitioned in ((main, MAIN, ""), (late, LATE, ""), (lake, LAKE, "PARTITIONED BY (dt)")):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema)}) USING parquet {partitioned}")


def debug_print(stream: DataFrame, name: str):
    """Start printing a stream to the console."""
    return stream.writeStream.format("console").queryName(name).option("truncate", "false").start()
