"""Live figures of streams against the batch figures of the same rows."""

import datetime as dt
import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY
from sluicegate.operators import clean, late
from sluicegate.plans import quality
from sluicegate.sinks import tables
from sluicegate.sources.logs import read_raw_files
from sluicegate.streaming import live, stages

BASE = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)
AS_OF = "2025-12-01 00:00:00"
ORDER = {"arrived_at": "timestamp", "arrival": "bigint"}
INPUT = "arrival bigint, arrived_at timestamp, raw string"


@pytest.fixture(scope="module")
def batches():
    """Micro-batches whose rows arrive up to minutes late, with repeats inside and across them, dirty and late ones."""
    rng, number, result = random.Random(11), 0, []
    for batch in range(6):
        rows = []
        for _ in range(50):
            arrived = BASE + dt.timedelta(seconds=batch * 60 + rng.choice([0, 5, 30, -90, -150]))
            when = BASE + dt.timedelta(seconds=batch * 20 + rng.randint(0, 5) - rng.choice([0, 0, 2, 40]))
            event = {"user_id": rng.choice(["hot", "u1", None]), "event_type": "view", "event_time": f"{when:%Y-%m-%d %H:%M:%S}",
                     "app_id": rng.choice(["h5", "h5", "h5", "pc"]), "device_id": rng.choice(["D", None])}
            rows.append((number, arrived, json.dumps(event)))
            number += 1
        result.append(rows)
    return result


def write_input(spark, root, *parts):
    for rows in parts:
        spark.createDataFrame(rows, INPUT).coalesce(1).write.mode("append").parquet(f"{root}/input")
        time.sleep(0.02)


def run(spark, root):
    source = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", 1).parquet(f"{root}/input")
    stages.start_cleaning(source, root, arrival=tuple(ORDER), trigger=None, quality=True, as_of=AS_OF).awaitTermination()
    stages.start_dedup(spark, root, arrival=ORDER, trigger=None, quality=True).awaitTermination()
    live.start_quality(spark, root, trigger=None).awaitTermination()
    live.start_late_counter(spark, root, trigger=None).awaitTermination()


def expected(spark, batches):
    rows = [(batch, *row) for batch, part in enumerate(batches) for row in part]
    tagged = clean.clean_events(spark.createDataFrame(rows, f"batch_id bigint, {INPUT}"), AS_OF)
    return tagged, late.route_late(clean.clean_rows(tagged, ("arrival", "arrived_at", "batch_id")))


def bag(df, *columns):
    return Counter(tuple(row[c] for c in columns) for row in df.collect())


def test_live_figures_equal_the_batch(spark, root, batches):
    write_input(spark, root, *batches[:2])
    run(spark, root)
    first = bag(live.read_quality(spark, root), "bucket_start", "status", "reason", "cnt")
    write_input(spark, root, *batches[2:])
    run(spark, root)
    tagged, routed = expected(spark, batches)
    order = F.struct("batch_id", "arrived_at", "arrival")
    want = quality.quality_monitor(tagged, routed.withColumn("order", order), "arrived_at", "order")
    columns = ("bucket_start", "status", "reason", "cnt")
    got = bag(live.read_quality(spark, root), *columns)
    assert got == bag(want, *columns) and {s for _, s, _, _ in got} == {"DIRTY", "LATE", "CLEAN", "DUPLICATE"}
    assert first - got  # figures of old buckets were corrected by batches that came later
    counts = ("late_cnt", *DEDUP_KEY)
    assert bag(live.read_late_counts(spark, root), *counts) == bag(late.late_counter(late.late_rows(routed)), *counts)
    run(spark, root)
    assert bag(live.read_quality(spark, root), *columns) == got


def test_counters_of_each_batch_are_stored(spark, root, batches):
    listener = live.CounterListener(spark, f"{root}/counters")
    spark.streams.addListener(listener)
    try:
        for part in (batches[:3], batches[3:]):
            write_input(spark, root, *part)
            source = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", 1).parquet(f"{root}/input")
            stages.start_cleaning(source, root, arrival=tuple(ORDER), trigger=None, quality=True, as_of=AS_OF).awaitTermination()
        deadline = time.time() + 60
        while live.read_counters(spark, f"{root}/counters").count() < 6 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    tagged, _ = expected(spark, batches)
    want = tagged.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("raw_cnt"), F.count_if(F.col("verdict") == "CLEAN").alias("cleaned_cnt"),
        F.count_if(F.col("verdict") == "DIRTY").alias("dirty_cnt"), F.max("event_time").alias("newest_event_time"),
    )
    columns = ("batch_id", "raw_cnt", "cleaned_cnt", "dirty_cnt", "newest_event_time")
    assert bag(live.read_counters(spark, f"{root}/counters"), *columns) == bag(want, *columns)


def test_counters_before_any_batch(spark, root):
    assert live.read_counters(spark, f"{root}/counters").isEmpty()


@pytest.mark.parametrize("wait", [False, True])
def test_idle_source(spark, root, wait):
    """Of two sources one never sends a row: results come out all the same, or wait for it."""
    schema = "seen timestamp, n bigint"
    for name in ("busy", "idle"):
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}/part=-1")
    for k in range(4):
        spark.createDataFrame([(BASE + dt.timedelta(minutes=10 * k), k)], schema).coalesce(1).write.parquet(f"{root}/busy/part={k}")
        time.sleep(0.02)
    sources = [spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}") for name in ("busy", "idle")]
    before = spark.conf.get(live.POLICY)
    try:
        both = live.union_sources(spark, sources, "seen", "1 minute", wait_for_idle=wait)
        counts = both.groupBy(F.window("seen", "5 minutes")).agg(F.sum("n").alias("n"))
        query = counts.writeStream.format("memory").queryName(f"idle_{wait}".lower()).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(r["n"] for r in spark.table(f"idle_{wait}".lower()).collect()) == ([] if wait else [0, 1, 2])
    finally:
        spark.conf.set(live.POLICY, before)


def test_restarted_read_equals_an_uninterrupted_one(spark, root):
    """Files in the order of their times, one per batch, stopped in the middle: the same rows with the same arrival columns."""
    for k in range(6):
        spark.createDataFrame([(f"{k}-{i}",) for i in range(3)], "raw string").coalesce(1).write.mode("append").text(f"{root}/in")
        time.sleep(0.02)

    def read(name, stop_after=None):
        seen = []

        def each(rows, batch_id):
            if stop_after is not None and batch_id >= stop_after:
                raise OSError("stopped")
            rows.select("raw", "topic", "arrival", "arrived_at").write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
            seen.append(batch_id)

        query = stages.start(read_raw_files(spark, f"{root}/in", max_files_per_trigger=1), f"{root}/cp-{name}", each, trigger=None)
        try:
            query.awaitTermination()
        except Exception:
            assert stop_after is not None
        return seen

    read("whole")
    assert read("cut", stop_after=2) == [0, 1]
    read("cut")
    rows = lambda name: sorted(map(tuple, spark.read.parquet(f"{root}/{name}").collect()))
    assert rows("cut") == rows("whole") and len(rows("cut")) == 18
    by_batch = spark.read.parquet(f"{root}/cut").groupBy("batch").agg(F.max("arrival").alias("a")).orderBy("batch").collect()
    assert [r["a"] for r in by_batch] == sorted(r["a"] for r in by_batch)


def test_debug_print_shows_a_stream(spark, root):
    spark.createDataFrame([("x",), ("y",)], "raw string").coalesce(1).write.parquet(f"{root}/in")
    query = tables.debug_print(spark.readStream.schema("raw string").parquet(f"{root}/in"), "shown")
    try:
        query.processAllAvailable()
        assert query.name == "shown" and sum(p.numInputRows for p in query.recentProgress) == 2
    finally:
        query.stop()


def test_streams_start_with_no_more_tasks_than_they_need(spark, monkeypatch):
    """Live figures run their own streams only, each with the given number of partitions, and the session's setting comes back."""
    from sluicegate.checks import queries

    small, before = "/root/testdata/sf0.001", spark.conf.get("spark.sql.shuffle.partitions")
    begun = []
    start = stages.start
    monkeypatch.setattr(stages, "start", lambda stream, checkpoint, *a, **k: begun.append((checkpoint.rpartition("/")[2], spark.conf.get("spark.sql.shuffle.partitions"))) or start(stream, checkpoint, *a, **k))
    monkeypatch.setattr(stages, "enough_tasks", lambda spark, rows: 2)
    queries.late_counter_live(spark, small)
    assert {name for name, _ in begun} == {"clean", "late_counter"} and {tasks for _, tasks in begun} == {"2"}
    begun.clear()
    queries.stream_late(spark, small)
    assert {name for name, _ in begun} == {"clean"}
    begun.clear()
    queries.quality_monitor_live(spark, small)
    assert {name for name, _ in begun} == {"clean", "dedup", "quality"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_number_of_tasks_follows_cores_and_rows(spark):
    with stages.shuffle_tasks(spark, 200):
        two_a_core = stages.enough_tasks(spark, 0)
        assert two_a_core == 2 * spark.sparkContext.defaultParallelism
        assert stages.enough_tasks(spark, 100 * stages.ROWS_PER_TASK) == 100
        assert stages.enough_tasks(spark, 1000 * stages.ROWS_PER_TASK) == 200
