"""Reading the main, late and lake tables back for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.session import work_dir


def read_ods_table(
    spark: SparkSession,
    name: str,
    jdbc: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A catalog table, a Parquet path (anything with a slash) or, with ``jdbc`` options, a database table.

    Database reads run in one task unless a partition column with bounds is given.
    """
    if jdbc is not None:
        reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", name)
        if partition_column and bounds and partitions:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=bounds[0],
                upperBound=bounds[1],
                numPartitions=str(partitions),
            )
        return reader.load()
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is used more than once to the shared folder and read it back.

    Cuts the lineage: what follows reads only the columns it needs, and a lost executor costs
    a re-read, not another parse.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filter_partition(df: DataFrame, dt: str) -> DataFrame:
    """Restrict a dated table to one day; only that day's folder is listed and read."""
    return df.where(F.col("dt") == F.lit(dt).cast("date"))
