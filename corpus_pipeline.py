"""From raw documents to packed token windows: five stages, each written as Parquet and read by the next.

All but the last stage return rows of the ``documents`` table. Every row goes or stays by itself, whatever its
``doc_id``: identifiers may be null and repeat, and of rows that are alike in everything one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from sluicegate.llm.common import staged, table


def _whole(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(number, row): rows with numbers of their own, written before use so that they stay the same."""
    return staged(spark, docs.select(F.monotonically_increasing_id().alias("number"), _whole(docs).alias("row")), "pipeline-rows")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    return rows.join(gone, "number", "left_anti").select("row.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, network, docs.columns).filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, one: that with the largest identifier, then the largest number."""
    rows = _numbered(spark, docs)
    named = rows.select(F.struct("row.doc_id", "number").alias("doc_id"), F.col("row.text").alias("text"))
    return _without(rows, exact_dedup.content_sort_dedup(named).filter("NOT kept").select("doc_id.number"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest identifier (null only if all are), then the smallest number."""
    rows = _numbered(spark, docs)
    found = near_dedup.near_duplicates(rows.select("number", F.col("row.text").alias("text")), id_col="number")
    alike = staged(spark, found.filter("class_size > 1").select("number", "class_id"), "pipeline-alike")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "number")
    stay = alike.join(rows.select("number", "row.doc_id"), "number").groupBy("class_id").agg(F.min(order).alias("least")).select("least.number")
    return _without(rows, alike.join(stay, "number", "left_anti").select("number"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    rows = docs.select(_whole(docs).alias("row"), "text")
    return decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col="row").filter("NOT contaminated").select("doc_id.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of fixed length, every source at its share of each window."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack_windows),
]

#: No SQL for a trained classifier, signatures and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = staged(spark, stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
