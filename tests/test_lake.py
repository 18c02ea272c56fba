"""The lake table: commits that repeat or fail, upserts, compaction, expiry."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicegate.plans import upkeep
from sluicegate.schema import CDC_EVENT
from sluicegate.sinks import lake as sink
from sluicegate.sources import lake

DAY = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)


def change(user, op="I", op_second=0, page=None, day=0, arrival=0):
    when = DAY + dt.timedelta(days=day)
    values = {"user_id": user, "event_type": "view", "event_time": when, "app_id": "h5", "page": page, "op_type": op,
              "op_ts": DAY + dt.timedelta(seconds=op_second)}
    return (arrival, *(values.get(name) for name in CDC_EVENT.fieldNames()))


def changes(spark, *rows):
    schema = "arrival bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CDC_EVENT.fields)
    return spark.createDataFrame(list(rows), schema)


def pages(spark, root, **options):
    return {(row["user_id"], row["dt"].day): row["page"] for row in lake.read_lake(spark, root, **options).collect()}


BOTH = pytest.mark.parametrize("apply", [sink.upsert_lake, sink.append_changes])


@BOTH
def test_updates_and_deletes_across_batches(spark, root, apply):
    apply(spark, root, changes(spark, change("a", page="1"), change("b", page="1"), change("c", page="1", day=1)), "x-0", "arrival")
    apply(spark, root, changes(spark, change("a", "U", 5, "2"), change("c", "D", 5, day=1)), "x-1", "arrival")
    assert pages(spark, root) == {("a", 11): "2", ("b", 11): "1"}
    apply(spark, root, changes(spark, change("a", "U", 3, "old"), change("c", "U", 4, "old", day=1)), "x-2", "arrival")
    assert pages(spark, root) == {("a", 11): "2", ("b", 11): "1"}
    apply(spark, root, changes(spark, change("c", "U", 9, "back", day=1)), "x-3", "arrival")
    assert pages(spark, root)[("c", 12)] == "back"


@BOTH
def test_repeated_batch_changes_nothing(spark, root, apply):
    batch = changes(spark, change("a", page="1"))
    assert apply(spark, root, batch, "x-0", "arrival")
    assert not apply(spark, root, batch, "x-0", "arrival")
    assert lake.read_stored(spark, root).count() == 1


def test_write_that_failed_before_its_commit(spark, root, monkeypatch):
    sink.upsert_lake(spark, root, changes(spark, change("a", page="1")), "x-0", "arrival")
    update = changes(spark, change("a", "U", 5, "2"), change("b", page="1"))
    with monkeypatch.context() as patch:
        patch.setattr(sink, "_commit_rows", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink.upsert_lake(spark, root, update, "x-1", "arrival")
    assert pages(spark, root) == {("a", 11): "1"}
    files = lake.lake_files(spark, lake.data_path(root))
    find = lambda: upkeep.find_orphan_files(lake.lake_files(spark, lake.data_path(root)), lake.read_commits(spark, root), "2999-01-01 00:00:00")
    left = {row["commit_id"] for row in find().collect()}
    assert len(left) == 1 and left.pop().startswith("x-1~")
    assert upkeep.find_orphan_files(files, lake.read_commits(spark, root)).isEmpty()  # too young to be given up
    sink.upsert_lake(spark, root, update, "x-1", "arrival")
    assert pages(spark, root) == {("a", 11): "2", ("b", 11): "1"}
    upkeep.delete_files(find())
    assert find().isEmpty() and pages(spark, root) == {("a", 11): "2", ("b", 11): "1"}


def test_second_rewrite_of_the_same_day_is_refused(spark, root):
    sink.upsert_lake(spark, root, changes(spark, change("a", page="1")), "x-0", "arrival")
    seen = lake.live_commits(lake.read_commits(spark, root))
    rows = lake.read_stored(spark, root, seen).drop("commit_id")
    sink.upsert_lake(spark, root, changes(spark, change("a", "U", 5, "2")), "x-1", "arrival")
    with pytest.raises(RuntimeError, match="rewritten the same days"):
        sink.commit(spark, root, rows, "compact-0", "replace", seen)
    assert pages(spark, root) == {("a", 11): "2"}


def test_compaction_keeps_rows_and_reduces_files(spark, root):
    for number in range(6):
        rows = [change(f"u{number}-{i}", page=str(i), day=i % 2, arrival=i) for i in range(40)]
        sink.append_changes(spark, root, changes(spark, *rows), f"x-{number}", "arrival")
    sink.append_changes(spark, root, changes(spark, change("u0-0", "D", 9)), "x-6", "arrival")
    before = pages(spark, root)
    report = upkeep.compact_partitions(spark, root, "compact-0").first()
    assert pages(spark, root) == before == pages(spark, root, resolve=False)
    assert (report["files_before"], report["files_after"]) == (13, 2) and report["reduction_pct"] == 84.6
    again = upkeep.compact_partitions(spark, root, "compact-1").first()
    assert again["files_before"] == again["files_after"] == 2 and again["reduction_pct"] == 0.0
    # rows appended after a compaction stay visible next to it
    sink.append_changes(spark, root, changes(spark, change("late", page="9")), "x-7", "arrival")
    assert pages(spark, root) == {**before, ("late", 11): "9"}
    old = upkeep.expired_files(spark, root, older_than="2999-01-01 00:00:00")
    assert old.isEmpty()  # the newest commits are kept whatever their age, compaction among them
    for number in range(8, 14):
        sink.append_changes(spark, root, changes(spark, change(f"n{number}")), f"x-{number}", "arrival")
    kept = pages(spark, root)
    old = upkeep.expired_files(spark, root, older_than="2999-01-01 00:00:00").collect()
    assert len(old) == 13
    assert upkeep.delete_files(spark.createDataFrame(old)) == 13
    assert not any(Path(row["file_path"].removeprefix("file:")).exists() for row in old)
    assert pages(spark, root) == kept


def test_compaction_splits_a_big_day(spark, root):
    rows = [change("hot" if i % 3 == 0 else f"u{i}", page="x" * 50 + str(i), day=0, arrival=i, op_second=i) for i in range(3000)]
    rows = [row[:2] + (f"t{i}",) + row[3:] for i, row in enumerate(rows)]
    sink.append_changes(spark, root, changes(spark, *rows), "x-0", "arrival")
    size = lake.live_lake_files(spark, root).agg(F.sum("file_size_in_bytes")).first()[0]
    before = lake.read_lake(spark, root).count()
    report = upkeep.compact_partitions(spark, root, "compact-0", target_bytes=size // 4, rewrite_all=True, min_input_files=1)
    assert report.first()["files_after"] in (4, 5)
    assert lake.read_lake(spark, root).count() == before == 3000


def test_day_filter_reaches_the_scan(spark, root):
    sink.append_changes(spark, root, changes(spark, change("a"), change("b", day=1)), "x-0", "arrival")
    plan = lake.read_lake(spark, root).where("dt = DATE'2025-11-12'")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "user_id" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*\(dt#\d+ = 2025-11-12\)", scan)


def listing(spark, *sizes, day="2025-11-11"):
    rows = [(dt.date.fromisoformat(day), f"f{i:03}", size) for i, size in enumerate(sizes)]
    return spark.createDataFrame(rows, "dt date, file_path string, file_size_in_bytes bigint")


def groups(plan):
    return sorted((row["bin_id"], row["input_files"], row["input_bytes"]) for row in upkeep.compaction_groups(plan).collect())


def test_compaction_plan(spark):
    small = listing(spark, *[10] * 12)
    assert groups(upkeep.plan_compaction(small, 100)) == [(0, 10, 100)]
    assert groups(upkeep.plan_compaction(small, 100, min_input_files=2)) == [(0, 10, 100), (1, 2, 20)]
    assert groups(upkeep.plan_compaction(listing(spark, 10, 10, 10, 10), 100)) == []
    assert groups(upkeep.plan_compaction(listing(spark, *[10] * 5, 100, 300), 100, max_bytes=500)) == [(0, 5, 50)]
    assert groups(upkeep.plan_compaction(listing(spark, 700), 100, max_bytes=500)) == [(6, 1, 700)]
    days = small.union(listing(spark, *[10] * 9, day="2025-11-12"))
    assert groups(upkeep.plan_compaction(days, 1000, dt="2025-11-12")) == [(0, 9, 90)]
    sliced = upkeep.plan_compaction(listing(spark, *[1] * 100), 1000, min_input_files=1, files_per_slice=10)
    assert sliced.count() == 100 and sliced.select("slice").distinct().count() > 5


def test_expiry_keeps_the_newest(spark):
    rows = [(i, DAY - dt.timedelta(days=i)) for i in range(20)]
    snapshots = spark.createDataFrame(rows, "snapshot_id bigint, committed_at timestamp")
    gone = upkeep.expire_snapshots(snapshots, as_of=DAY).collect()
    assert {row["snapshot_id"] for row in gone} == set(range(8, 20))
    gone = upkeep.expire_snapshots(snapshots, older_than="2999-01-01", retain_last=5).collect()
    assert {row["snapshot_id"] for row in gone} == set(range(5, 20))
    assert lake.recent_snapshots(snapshots.selectExpr("*", "'append' AS operation", "map() AS summary")).count() == 20


def test_bloom_filters_and_compression(spark, root):
    import pyarrow.parquet as pq

    sink.append_changes(spark, root, changes(spark, change("a")), "x-0", "arrival")
    path = lake.live_lake_files(spark, root).first()["file_path"].removeprefix("file:")
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"
    assert sink.bloom_filter_columns()["parquet.bloom.filter.enabled#user_id"] == "true"
