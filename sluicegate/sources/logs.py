"""Raw text sources. Batch and stream alike give one ``raw`` column, with the arrival order where known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_raw_logs(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Continuous read of a Kafka topic (needs the Kafka connector on the class path).

    Progress is kept in the query's checkpoint, not in a consumer group.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return kafka_to_raw(reader.options(**(options or {})).load())


def kafka_to_raw(records: DataFrame) -> DataFrame:
    """Value bytes as UTF-8 text; topic, partition, offset and time say when a message arrived."""
    return records.select(
        F.col("value").cast("string").alias("raw"),
        "topic",
        "partition",
        F.col("offset").alias("arrival"),
        F.col("timestamp").alias("arrived_at"),
    )


def read_raw_files(
    spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same from text files, one message per line. Files arrive in the order of their times; lines of one file arrive together."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.format("text").load(path)
    return lines.select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("topic"),
        F.unix_micros("_metadata.file_modification_time").alias("arrival"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )


def read_cdc_envelopes(
    spark: SparkSession, topic: str, bootstrap_servers: str, starting_offsets: str = "latest", **kwargs
) -> DataFrame:
    """Change envelopes (``op``, ``before``, ``after``, ``ts_ms``) from Kafka; empty messages are skipped."""
    return without_empty(read_raw_logs(spark, topic, bootstrap_servers, starting_offsets, **kwargs))


def without_empty(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(F.col("raw").isNotNull() & (F.col("raw") != ""))
