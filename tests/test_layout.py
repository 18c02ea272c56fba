"""Clustered files and what they let a reader skip; distinct counts from sketches."""

import datetime as dt
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sluicegate.plans import reports, sketches, upkeep
from sluicegate.sinks import tables

DAY = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def visits(spark):
    """Three days, a third of the rows of one user, the others of 3,000 users."""
    hot = F.col("id") % 3 == 0
    rows = spark.range(60_000).select(
        F.when(hot, "U000007").otherwise(F.concat(F.lit("U"), F.lpad((F.xxhash64("id") % 1500 + 1500).cast("string"), 6, "0"))).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.timestamp_seconds(F.lit(int(DAY.timestamp())) + F.col("id") * 4).alias("event_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("page"),
        F.lit(None).cast("string").alias("product_id"),
        F.lit(None).cast("bigint").alias("duration_ms"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("D"), (F.col("id") % 2000).cast("string"))).alias("device_id"),
    )
    return rows.withColumn("dt", F.to_date("event_time")).repartition(8).cache()


def groups_of(path, user):
    """Row groups of a table, and how many of them may hold a user by their minimum and maximum."""
    total = found = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = meta.schema.to_arrow_schema().get_field_index("user_id")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            total += 1
            found += stats.min <= user <= stats.max
    return total, found


def test_clustering_lets_a_user_be_found_in_few_row_groups(spark, root, visits):
    ranges = tables.write_clustered(visits, f"{root}/clustered", target_bytes=200_000, row_group_bytes=50_000)
    visits.repartition(ranges).write.option("parquet.block.size", 50_000).partitionBy("dt").parquet(f"{root}/plain")
    assert ranges > 5
    user = "U001500"
    total, found = groups_of(f"{root}/clustered", user)
    plain_total, plain_found = groups_of(f"{root}/plain", user)
    assert plain_found > 0.9 * plain_total and found <= 0.2 * total
    whole = lambda path: Counter(map(tuple, spark.read.parquet(path).select(*visits.columns).collect()))
    assert whole(f"{root}/clustered") == Counter(map(tuple, visits.collect()))
    trip = lambda rows: list(map(tuple, reports.user_trajectory(rows, user, ()).collect()))
    assert trip(spark.read.parquet(f"{root}/clustered")) == trip(visits)
    sizes = [p.stat().st_size for p in Path(f"{root}/clustered").rglob("*.parquet")]
    assert max(sizes) < 2.5 * 200_000 and len(sizes) <= ranges + 3


def test_clustered_write_of_nothing(spark, root, visits):
    assert tables.write_clustered(visits.limit(0), f"{root}/none") == 1


def test_sketches_are_close_and_mergeable(spark, root, visits):
    for number in range(4):
        sketches.write_sketches(visits.where(F.pmod(F.xxhash64("page"), F.lit(4)) == number), f"{root}/sketches", number)
    sketches.write_sketches(visits.where(F.pmod(F.xxhash64("page"), F.lit(4)) == 1), f"{root}/sketches", 1)  # a repeated batch
    exact = {r["dt"]: r for r in upkeep.partition_distribution(visits).collect()}
    report = sketches.sketched_distribution(spark, f"{root}/sketches")
    for row in report.collect():
        want = exact.pop(row["dt"])
        assert row["rows"] == want["rows"]
        assert all(abs(row[n] - want[n]) <= 0.02 * want[n] for n in ("users", "devices"))
    assert not exact
    assert report.inputFiles() and all("/sketches/batch_id=" in name for name in report.inputFiles())  # no row is read
    sketches.merge_sketches(spark, f"{root}/sketches", f"{root}/folded", 0)
    folded = sketches.sketched_distribution(spark, f"{root}/folded").collect()
    assert spark.read.parquet(f"{root}/folded").count() == len(folded) == 3
    assert sorted(map(tuple, folded)) == sorted(map(tuple, report.collect()))


def test_sketch_of_null_users(spark, root, visits):
    sketches.write_sketches(visits.withColumn("user_id", F.lit(None).cast("string")), f"{root}/sketches", 0)
    assert {r["users"] for r in sketches.sketched_distribution(spark, f"{root}/sketches").collect()} == {0}


def test_counts_of_kept_values_are_exact(spark, root):
    """Several thousand users a day, which a sketch no longer tells apart; batches share users, and one is repeated."""
    seen = spark.range(40_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("dt"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("U"), (F.col("id") % 18_001).cast("string"))).alias("user_id"),
        F.when(F.col("id") % 2 == 1, F.concat(F.lit("D"), (F.col("id") % 5).cast("string"))).alias("device_id"),
        (F.col("id") % 3).alias("batch"),
    )
    for number in (0, 1, 2, 1):
        batch = seen.where(F.col("batch") == number)
        sketches.write_sketches(batch, f"{root}/sketches", number)
        sketches.write_values(batch, f"{root}/values", number)
    exact = upkeep.partition_distribution(seen).collect()
    assert sketches.exact_distribution(spark, f"{root}/sketches", f"{root}/values").collect() == exact
    assert sketches.exact_distribution(spark, f"{root}/sketches", f"{root}/values", last=1).collect() == exact[:1]
    assert sketches.sketched_distribution(spark, f"{root}/sketches").collect() != exact
