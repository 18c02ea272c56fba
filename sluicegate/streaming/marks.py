"""The high-water mark: the greatest clean event time seen up to each micro-batch."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluicegate.session import delete_path
from sluicegate.sinks.tables import write_batch

_SCHEMA = "greatest timestamp, owner string"
#: Marks kept behind the newest; a restart needs the last two.
KEPT = 10


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The identity of the stream that owns a checkpoint, None for a batch function run by itself.

    Batch numbers only mean something together with it.
    """
    try:
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_mark(spark: SparkSession, path: str, batch_id: int, owner: str | None = None) -> tuple[bool, dt.datetime | None]:
    """Whether the batch was finished, and the mark it left. Reads one row of one folder.

    A mark of another stream is refused: its batch of that number held other rows.
    """
    try:
        row = spark.read.schema(_SCHEMA).parquet(f"{path}/batch_id={batch_id}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False, None
    if row is None:
        return False, None
    if owner and row["owner"] and row["owner"] != owner:
        raise RuntimeError(f"{path} holds marks of another stream; use another root, or that stream's checkpoint")
    return True, row["greatest"]


def write_mark(spark: SparkSession, path: str, batch_id: int, greatest: dt.datetime | None, owner: str | None = None) -> None:
    mark = spark.range(1).select(F.lit(greatest).cast("timestamp").alias("greatest"), F.lit(owner).cast("string").alias("owner"))
    write_batch(mark.coalesce(1), path, batch_id, rebalance=False)
    delete_path(spark, f"{path}/batch_id={batch_id - KEPT}")


def read_position(spark: SparkSession, path: str, batch_id: int) -> tuple[bool, int | None]:
    """Whether the second stream finished a batch, and the newest batch of the first stream that it had met by then."""
    try:
        row = spark.read.schema("newest bigint").parquet(f"{path}/batch_id={batch_id}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False, None
    return (False, None) if row is None else (True, row["newest"])


def write_position(spark: SparkSession, path: str, batch_id: int, newest: int | None) -> None:
    row = spark.range(1).select(F.lit(newest).cast("bigint").alias("newest"))
    write_batch(row.coalesce(1), path, batch_id, rebalance=False)
    delete_path(spark, f"{path}/batch_id={batch_id - KEPT}")
