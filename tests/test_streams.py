"""Streams give what the batch operators give, whatever is restarted in between."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY
from sluicegate.operators import clean, dedup, late
from sluicegate.sources import lake
from sluicegate.streaming import changes, jobs, stages

BASE = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)
AS_OF = "2025-12-01 00:00:00"


@pytest.fixture(scope="module")
def batches():
    """Five micro-batches with repeats inside and across them, late, dirty and on-the-mark rows."""
    rng, number, result = random.Random(3), 0, []
    for batch in range(5):
        rows = []
        for i in range(40):
            seconds = batch * 20 + i // 2 - rng.choice([0, 0, 0, 2, 5, 30])
            user = rng.choice(["hot", "hot", "u1", "u2"])
            event = {"user_id": user, "event_type": "view", "event_time": f"{BASE + dt.timedelta(seconds=seconds):%Y-%m-%d %H:%M:%S}",
                     "app_id": rng.choice(["h5", "h5", "h5", "pc"]), "device_id": rng.choice(["D", None]), "n": number}
            rows.append((number, json.dumps(event)))
            number += 1
        result.append(rows)
    return result


def write_input(spark, root, *parts):
    for rows in parts:
        spark.createDataFrame(rows, "arrival bigint, raw string").coalesce(1).write.mode("append").parquet(f"{root}/input")
        time.sleep(0.02)


def source(spark, root):
    return spark.readStream.schema("arrival bigint, raw string").option("maxFilesPerTrigger", 1).parquet(f"{root}/input")


def clean_and_dedup(spark, root, **options):
    stages.start_cleaning(source(spark, root), root, trigger=None, as_of=AS_OF, **options).awaitTermination()
    query = stages.start_dedup(spark, root, trigger=None)
    query.awaitTermination()
    stages.check_nothing_dropped(query)


def expected(spark, batches):
    rows = [(batch, *row) for batch, part in enumerate(batches) for row in part]
    tagged = clean.clean_events(spark.createDataFrame(rows, "batch_id bigint, arrival bigint, raw string"), AS_OF)
    routed = late.route_late(clean.clean_rows(tagged, ("arrival", "batch_id")))
    return tagged, dedup.dedup_first_seen(late.on_time_rows(routed)), late.late_rows(routed)


def values(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def assert_like_batch(spark, root, batches):
    tagged, main, late_found = expected(spark, batches)
    key = [*DEDUP_KEY, "ext_json"]
    assert values(spark.read.parquet(f"{root}/main"), *key) == values(main, *key)
    assert values(spark.read.parquet(f"{root}/late"), *key, "late_ms", "source_watermark") == values(
        late_found, *key, "late_ms", "source_watermark"
    )
    assert values(spark.read.parquet(f"{root}/dirty"), "arrival") == values(tagged.where("verdict = 'DIRTY'"), "arrival")
    assert late_found.count() > 5


def test_stream_equals_batch(spark, root, batches):
    write_input(spark, root, *batches)
    clean_and_dedup(spark, root)
    assert_like_batch(spark, root, batches)


def test_restart_from_the_checkpoint(spark, root, batches):
    write_input(spark, root, *batches[:2])
    clean_and_dedup(spark, root)
    write_input(spark, root, *batches[2:])
    clean_and_dedup(spark, root)
    assert_like_batch(spark, root, batches)


def test_failure_inside_a_batch(spark, root, batches):
    """The third batch fails after part of its rows were written; nothing is lost or doubled."""
    write_input(spark, root, *batches)
    failures = []

    def failing(rows, batch_id):
        stages.parquet_writer(f"{root}/late")(rows, batch_id)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise OSError("disk gone")

    with pytest.raises(StreamingQueryException):
        clean_and_dedup(spark, root, write_late=failing)
    clean_and_dedup(spark, root, write_late=failing)
    assert failures == [2]
    assert_like_batch(spark, root, batches)


def test_finished_batch_is_not_written_again(spark, root, batches):
    tagged = clean.clean_events(spark.createDataFrame(batches[0], "arrival bigint, raw string"), AS_OF)
    calls = []
    each_batch = stages.route_batch(root, lambda rows, batch_id: calls.append(batch_id))
    each_batch(tagged, 0)
    each_batch(tagged, 0)
    assert calls == [0]


def test_plain_ingestion(spark, root, batches):
    write_input(spark, root, *batches)
    stages.start_plain_ingestion(source(spark, root), root, trigger=None, as_of=AS_OF).awaitTermination()
    tagged, _, _ = expected(spark, batches)
    assert spark.read.parquet(f"{root}/main").count() == tagged.where("verdict = 'CLEAN'").count()
    assert spark.read.parquet(f"{root}/dirty").count() == tagged.where("verdict = 'DIRTY'").count()


def test_rows_on_time_in_an_ended_stream_are_kept(spark, root):
    """A row exactly at the watermark is on time, and Spark's own watermark must not drop it."""
    def rows(*pairs):
        return [(n, json.dumps({"user_id": "u", "event_type": "view", "app_id": "h5",
                                "event_time": f"{BASE + dt.timedelta(seconds=s):%Y-%m-%d %H:%M:%S}"})) for n, s in pairs]

    write_input(spark, root, rows((0, 100)), rows((1, 100)), rows((2, 95), (3, 94)), rows((4, 95)))
    clean_and_dedup(spark, root)
    times = [row[0] for row in spark.read.parquet(f"{root}/main").select(F.unix_timestamp("event_time")).collect()]
    assert sorted(t - int(BASE.timestamp()) for t in times) == [95, 100]


def test_changes_into_the_lake(spark, root):
    def envelope(op, page, ts):
        row = {"user_id": "U1", "event_type": "pay", "event_time": "2025-11-11 09:30:00", "app_id": "h5", "page": page}
        return json.dumps({"op": op, "before": row, "after": row, "ts_ms": ts})

    write_input(spark, root, [(0, envelope("c", "1", 1000)), (1, "{}")], [(2, envelope("u", "2", 2000))])
    changes.start_cdc_to_lake(source(spark, root), root, trigger=None).awaitTermination()
    write_input(spark, root, [(3, envelope("u", "old", 1500))])
    changes.start_cdc_to_lake(source(spark, root), root, trigger=None).awaitTermination()
    assert [row["page"] for row in lake.read_lake(spark, root).collect()] == ["2"]
    assert lake.lake_snapshots(lake.read_commits(spark, root)).count() == 3
    assert [row["reason"] for row in spark.read.parquet(f"{root}/dirty").collect()] == ["UNKNOWN_OP"]


def test_time_to_live_stream(spark, root):
    rows = [(i, "u", "view", None, BASE, f"p{i}") for i in (3, 1, 2)]
    schema = "arrival bigint, user_id string, event_type string, device_id string, event_time timestamp, page string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/input")
    stream = changes.dedup_ttl_stream(spark.readStream.schema(schema).parquet(f"{root}/input"))
    query = stream.writeStream.format("memory").queryName("ttl").option("checkpointLocation", f"{root}/cp").start()
    try:
        deadline = time.time() + 90
        while spark.table("ttl").isEmpty() and time.time() < deadline:
            time.sleep(0.5)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/input")
        query.awaitTermination(8)
        assert [row["arrival"] for row in spark.table("ttl").collect()] == [1]
    finally:
        query.stop()


def test_bounded_restarts(spark):
    starts = []

    class Query:
        def awaitTermination(self):
            if len(starts) < 3:
                raise RuntimeError("lost")

    jobs.run_with_restarts(lambda: starts.append(1) or Query(), restarts=3, pause_seconds=0)
    assert len(starts) == 3
    starts.clear()
    with pytest.raises(RuntimeError):
        jobs.run_with_restarts(lambda: starts.append(1) or Query(), restarts=1, pause_seconds=0)
    assert len(starts) == 2


def test_live_counters(spark, root, batches):
    write_input(spark, root, batches[0])
    tagged = jobs.observe_quality(clean.clean_events(source(spark, root), AS_OF))
    query = tagged.writeStream.format("noop").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    counts = next(p.observedMetrics["quality"] for p in query.recentProgress if "quality" in p.observedMetrics)
    assert counts.raw_cnt == 40 and counts.cleaned_cnt + counts.dirty_cnt == 40
