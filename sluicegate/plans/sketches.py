"""Rows, users and devices per day from what is kept per batch, so that no report reads the rows again.

Sketches give estimates in bounded space. Where the figures have to be exact, :func:`write_values` keeps each day's different users and
devices of a batch beside them, and :func:`exact_distribution` counts those over all batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.sinks.tables import write_batch

#: Logarithm of a sketch's registers: a relative error of about 0.8 %, 16 kB a day and batch at most.
REGISTERS = 14
_COUNTED = {"users": "user_id", "devices": "device_id"}


def day_sketches(rows: DataFrame, registers: int = REGISTERS) -> DataFrame:
    """``dt, rows, users, devices``: a count and two sketches per day; sketches of a day are merged in the map tasks too."""
    sketches = [F.hll_sketch_agg(column, registers).alias(name) for name, column in _COUNTED.items()]
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), *sketches)


def write_sketches(rows: DataFrame, path: str, batch_id: int, registers: int = REGISTERS) -> None:
    """Keep the sketches of a batch; repeating the batch replaces them."""
    write_batch(day_sketches(rows, registers), path, batch_id)


def sketched_distribution(spark: SparkSession, path: str, last: int | None = C.REPORT_PARTITIONS) -> DataFrame:
    """The newest days' rows, users and devices, out of the sketches of all batches.

    Null users and devices count for nothing, as in the exact :func:`~sluicegate.plans.upkeep.partition_distribution`.
    """
    counts = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name) for name in _COUNTED]
    days = spark.read.parquet(path).groupBy("dt").agg(F.sum("rows").alias("rows"), *counts)
    return days if last is None else days.orderBy(F.col("dt").desc()).limit(last)


def day_values(rows: DataFrame) -> DataFrame:
    """``dt, counted, value``: the different users and devices of each day, one row each."""
    both = F.array(*(F.struct(F.lit(name).alias("counted"), F.col(column).cast("string").alias("value")) for name, column in _COUNTED.items()))
    return rows.select("dt", F.explode(both).alias("_one")).select("dt", "_one.*").where("value IS NOT NULL").distinct()


def write_values(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep the values of a batch; repeating the batch replaces them."""
    write_batch(day_values(rows), path, batch_id)


def exact_distribution(spark: SparkSession, path: str, values: str, last: int | None = C.REPORT_PARTITIONS) -> DataFrame:
    """The newest days as :func:`sketched_distribution` gives them, with counts of the values instead of estimates.

    A value that several batches have is counted once. No task holds the values of a day: they are dealt out one by one.
    """
    number = lambda name: F.count(F.when(F.col("counted") == name, 1)).alias(name)
    none = F.lit(0).cast("bigint")
    counts = spark.read.parquet(values).select("dt", "counted", "value").distinct().groupBy("dt").agg(*map(number, _COUNTED))
    rows = spark.read.parquet(path).select("dt", "rows", *(none.alias(name) for name in _COUNTED))
    parts = rows.unionByName(counts.withColumn("rows", none))
    days = parts.groupBy("dt").agg(*(F.sum(name).alias(name) for name in ("rows", *_COUNTED)))
    return days if last is None else days.orderBy(F.col("dt").desc()).limit(last)


def merge_sketches(spark: SparkSession, path: str, target: str, batch_id: int) -> None:
    """Fold the sketches of all batches below ``path`` into one row per day below ``target``."""
    merged = [F.hll_union_agg(name).alias(name) for name in _COUNTED]
    write_batch(spark.read.parquet(path).groupBy("dt").agg(F.sum("rows").alias("rows"), *merged), target, batch_id)
