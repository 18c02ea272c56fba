"""Connected components of links, by alternating stars over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link, root being the smallest node of its component.

    ``links`` has columns ``a`` and ``b``. Every round links each node's greater neighbours, then its smaller
    ones, to the smallest it knows; the number of rounds grows with the logarithm of the largest component.
    Nodes with very many links are met by partial minima and by splitting skewed joins.
    """
    spark = links.sparkSession
    edges = staged(spark, _ordered(links), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = _ordered(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.withColumnRenamed("m", "b"))
        edges = staged(spark, _ordered(small), "links")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, its greater node first."""
    return links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
