"""Helpers shared by the operators: null-safe texts, staged tables, running totals, bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.session import work_dir

if TYPE_CHECKING:
    import pyarrow as pa

#: Bytes of text that a Python task handles at once.
SLICE_BYTES = 4 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone.

    ``lower`` does the same, and faster, where a text has no other characters.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def staged(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, so that nothing is worked out twice."""
    path = path or work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(rows: DataFrame, order: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest different values of ``order``, a hash.

    Only the hashes are sorted; the rows are then picked out by a table of at most ``most`` numbers.
    """
    picked = rows.select(order).distinct().orderBy(order).limit(most)
    return rows.join(F.broadcast(picked), order, "left_semi").dropDuplicates([order])


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def with_start(counts: DataFrame, group: list[str], order: str, size: str, start: str, block: int = 4096) -> DataFrame:
    """Add the sum of ``size`` over smaller ``order`` (an integer) of the same group.

    Blocks of consecutive order numbers are summed first, so that no task needs more than one
    block and one row per block of a group, whatever their number.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(order) / block))
    before = Window.partitionBy(*group, F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        blocked.groupBy(*group, "_block")
        .agg(F.sum(size).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    inside = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    matching = [blocked[c].eqNullSafe(sums[c]) for c in [*group, "_block"]]
    joined = blocked.join(sums, matching).select(blocked["*"], sums["_base"])
    return joined.withColumn(start, F.col("_base") + F.coalesce(F.sum(size).over(inside), F.lit(0))).drop("_block", "_base")


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``most`` bytes of ``column``, or a single row."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
