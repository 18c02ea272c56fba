"""Exact de-duplication by sorting whole texts.

Spark samples splitters of the normalised texts (their first characters, then a hash) and deals
the rows out by range; each task sorts its range externally, which puts equal texts next to each
other, and the window over the text compares each text with its neighbour in full. Range
partitioning already keeps equal texts together, so the window needs no second shuffle. Only
DataFrame functions are used.

A text that makes up more than ``1 / parts`` of all rows (so there are fewer than ``parts`` such
texts) is dealt out over ``parts`` salts, by identifier and by the task that read the row, so that copies without
identifiers part as well, and the few runs that result are combined afterwards. A repeated task deals its rows alike,
in whatever order it meets them.

Nulls: a null text counts as empty. A null identifier is smaller than any other. Repeated rows
(same text, same identifier): each stays a row of its own and all carry the same ``kept``. An empty
table gives no rows. Extra columns are left out of the result and may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.llm.common import lower_ascii, staged, table, text_of

#: A text with more than one in so many rows is split; also the number of its salts.
PARTS = 200
#: Characters of a text that the sampled splitters hold; texts alike so far are placed by a hash.
PREFIX = 16


def content_sort_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: str = "largest", parts: int = PARTS
) -> DataFrame:
    """One row per document: the identifier, that of the row that stays, group size, kept, text hash.

    ``keep`` is ``smallest`` or ``largest``: which identifier of equal texts stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    spark = docs.sparkSession
    best = F.max if keep == "largest" else F.min
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text).alias("_raw"))
    # Coarser than equality after A-Z only: finds every hot text, and a few others do no harm.
    hashed = rows.select(F.xxhash64(F.lower("_raw")).alias("_hash"))
    counts = staged(spark, hashed.groupBy("_hash").count().filter(F.col("count") > parts), "exact-counts")
    total = rows.count()
    hot = counts.filter(F.col("count") > F.lit(total / parts)).select("_hash")
    salted = (
        rows.withColumn("_hash", F.xxhash64(F.lower("_raw")))
        .join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_hash", "left")  # fewer than `parts` rows
        .select(
            "_id",
            lower_ascii(F.col("_raw")).alias("_text"),
            F.when(F.col("_hot"), F.pmod(F.xxhash64(F.lit("salt"), F.col("_id"), F.spark_partition_id()), F.lit(parts)) + 1).otherwise(F.lit(0)).alias("_salt"),
        )
    )
    # Splitters are sampled from the first characters and a hash: whole texts would flood the driver.
    place = [F.substring("_text", 1, PREFIX).alias("_prefix"), F.xxhash64("_text").alias("_hash")]
    run = Window.partitionBy("_prefix", "_hash", "_salt", "_text")
    sorted_rows = salted.select("*", *place).repartitionByRange(_partitions(spark), "_prefix", "_hash", "_salt").select(
        "_id",
        "_salt",
        F.sha2(F.col("_text"), 256).alias("text_sha256"),
        best("_id").over(run).alias("_best"),
        F.count(F.lit(1)).over(run).alias("_n"),
    )
    runs = staged(spark, sorted_rows, "exact-runs")
    joined = (
        runs.filter("_salt > 0")
        .groupBy("text_sha256", "_salt")
        .agg(F.first("_best").alias("_best"), F.first("_n").alias("_n"))
        .groupBy("text_sha256")
        .agg(best("_best").alias("_all_best"), F.sum("_n").alias("_all_n"))
    )
    whole = runs.join(F.broadcast(joined), "text_sha256", "left")  # one row per hot text: fewer than `parts`
    kept_id = F.when(F.col("_salt") > 0, F.col("_all_best")).otherwise(F.col("_best"))
    return whole.select(
        F.col("_id").alias("doc_id"),
        kept_id.alias("keep_id"),
        F.when(F.col("_salt") > 0, F.col("_all_n")).otherwise(F.col("_n")).alias("group_size"),
        F.col("_id").eqNullSafe(kept_id).alias("kept"),
        "text_sha256",
    )


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), w AS (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
