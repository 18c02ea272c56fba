"""Late routing and de-duplication against straightforward loops over small, uneven inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY
from sluicegate.operators import cdc, dedup, late
from sluicegate.plans import quality, reports

BASE = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def arrivals():
    """Unique, gappy arrival numbers; one user holds a third of all rows; times jump back and forth."""
    rng = random.Random(7)
    rows, number = [], 0
    for i in range(600):
        number += rng.choice([1, 1, 1, 7, 40])
        user = "hot" if rng.random() < 0.34 else f"u{rng.randrange(40)}"
        back = rng.choice([0, 0, 0, 1, 5, 6, 7, 60])
        batch = 3 if 100 <= i < 300 else i // 20
        rows.append((number, batch, user, rng.choice(["view", "pay"]), rng.choice(["D1", None]), at(i // 4 - back)))
    return rows


def frame(spark, arrivals):
    schema = "arrival bigint, batch_id bigint, user_id string, event_type string, device_id string, event_time timestamp"
    return spark.createDataFrame(arrivals, schema).repartition(5)


def expected_late(arrivals, position):
    """Arrival -> late milliseconds, with the mark moving after each group of equal ``position``."""
    found, mark = {}, None
    for place in sorted({row[position] for row in arrivals}):
        group = [row for row in arrivals if row[position] == place]
        for row in group:
            if mark is not None and row[5] < mark - dt.timedelta(seconds=5):
                found[row[0]] = int((mark - dt.timedelta(seconds=5) - row[5]).total_seconds() * 1000)
        mark = max([row[5] for row in group] + ([mark] if mark else []))
    return found


def routed_late(routed):
    return {row["arrival"]: row["late_ms"] for row in late.late_rows(routed).collect()}


@pytest.mark.parametrize("segment", [1, 10, 97, 1_000_000])
def test_route_per_record(spark, arrivals, segment):
    routed = late.route_late_per_record(frame(spark, arrivals), segment=segment)
    assert routed_late(routed) == expected_late(arrivals, 0)


def test_route_by_batch(spark, arrivals):
    arrivals = sorted(arrivals, key=lambda row: row[1])
    assert routed_late(late.route_late(frame(spark, arrivals))) == expected_late(arrivals, 1)


def test_prior_max_over_many_levels(spark):
    rows = spark.range(500).select((F.col("id") * 3).alias("n"), (F.col("id") * 7919 % 501).alias("v"))
    got = late.prior_max(rows, "n", "v", "m", segment=5, group=4).collect()
    best = None
    for row in sorted(got, key=lambda r: r["n"]):
        assert row["m"] == best
        best = row["v"] if best is None else max(best, row["v"])


def test_row_at_the_watermark_is_on_time(spark):
    rows = [(1, 1, "u", "view", "D", at(10)), (2, 2, "u", "view", "D", at(5)), (3, 3, "u", "view", "D", at(4))]
    assert routed_late(late.route_late_per_record(frame(spark, rows))) == {3: 1000}


def test_on_time_and_late_make_up_the_input(spark, arrivals):
    routed = late.route_late_per_record(frame(spark, arrivals))
    assert late.on_time_rows(routed).count() + late.late_rows(routed).count() == len(arrivals)
    counted = late.late_counter(late.late_rows(routed)).agg(F.sum("late_cnt")).first()[0]
    assert counted == len(expected_late(arrivals, 0))


def test_first_seen(spark, arrivals):
    first = {}
    for row in arrivals:
        first.setdefault(row[2:], row[0])
    once = dedup.dedup_first_seen(frame(spark, arrivals))
    assert {row["arrival"] for row in once.collect()} == set(first.values())
    assert dedup.dedup_first_seen(once).count() == once.count()


def test_repeats_are_dropped_before_the_shuffle(spark, arrivals):
    plan = dedup.dedup_first_seen(frame(spark, arrivals))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("ttl_ms", [1, 60_000, 3_600_000, 10**9])
def test_ttl(spark, ttl_ms):
    rng = random.Random(ttl_ms)
    rows, clock = [], 0.0
    for i in range(400):
        clock += rng.choice([0, 0.001, 1, 59.999, 60, 3000])
        rows.append((i, "hot" if rng.random() < 0.4 else rng.choice(["a", None]), at(clock)))
    seen, kept = {}, set()
    for number, key, when in rows:
        ms = round((when - BASE).total_seconds() * 1000)
        if key not in seen or ms - seen[key] >= ttl_ms:
            seen[key] = ms
            kept.add(number)
    df = spark.createDataFrame(rows, "arrival bigint, user_id string, arrived_at timestamp").repartition(3)
    assert {row["arrival"] for row in dedup.dedup_ttl(df, key=("user_id",), ttl_ms=ttl_ms).collect()} == kept


def test_ttl_of_one_steady_key(spark):
    """One key without a pause over many periods, before and after 1970, next to keys that return after one."""
    start = dt.datetime(1969, 12, 31, tzinfo=dt.timezone.utc)
    rows = [(i, "hot", start + dt.timedelta(seconds=37 * i)) for i in range(5000)]
    rows += [(10_000 + i, f"u{i % 7}", start + dt.timedelta(seconds=i * 1200)) for i in range(140)]
    want, last = set(), {}
    for number, key, when in sorted(rows, key=lambda r: r[2]):
        if key not in last or (when - last[key]).total_seconds() >= 3600:
            last[key] = when
            want.add(number)
    df = spark.createDataFrame(rows, "arrival bigint, user_id string, arrived_at timestamp").repartition(5)
    found = dedup.dedup_ttl(df, key=("user_id",))
    assert {row["arrival"] for row in found.collect()} == want
    assert "Arrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_few_rows_of_a_key_are_followed_in_one_pass(spark):
    """Keys of few rows give what linked successors give, without them; nulls in key, time and device, repeats in one instant."""
    rng = random.Random(8)
    rows = []
    for number in range(900):
        seen = None if rng.random() < 0.05 else at(rng.choice([0, 1, 600, 3599, 3600, 3601, 7200, 7200, 9000, 20_000]) + rng.choice([0, 0, 1]))
        rows.append((number, f"u{rng.randint(0, 120)}", "view", rng.choice([None, "D"]), at(0), {"n": number}, seen))
    columns = "arrival bigint, user_id string, event_type string, device_id string, event_time timestamp, extra map<string, int>, arrived_at timestamp"
    df = spark.createDataFrame(rows, columns).repartition(4)
    followed, linked, mixed = (dedup.dedup_ttl(df, few_rows=n) for n in (200, 0, 4))
    assert followed.columns == linked.columns == df.columns
    want = sorted((r["arrival"], r["device_id"], r["extra"]["n"]) for r in linked.collect())
    for found in (followed, mixed):
        assert sorted((r["arrival"], r["device_id"], r["extra"]["n"]) for r in found.collect()) == want
    assert followed._jdf.queryExecution().executedPlan().toString().count("Window") == 0


def test_change_that_returns_after_the_period(spark):
    columns = "arrival bigint, user_id string, event_type string, device_id string, event_time timestamp, op_type string, seen timestamp"
    rows = [(k, "u", "view", None, at(0), op, at(s)) for k, op, s in [(0, "I", 0), (1, "U", 3599), (2, "D", 3600), (3, "I", 7199)]]
    df = spark.createDataFrame(rows, columns)
    assert [r["op_type"] for r in cdc.cdc_first_seen(df).collect()] == ["I"]
    assert sorted(r["arrival"] for r in cdc.cdc_first_seen(df, arrived_at="seen").collect()) == [0, 2]


def test_event_time_falls_back_to_the_record_time(spark):
    df = spark.createDataFrame([(None, at(3)), (at(1), at(3))], "event_time timestamp, ts timestamp")
    start = int(BASE.timestamp() * 1000)
    assert [r["event_ts"] - start for r in late.assign_event_time(df, "ts").collect()] == [3000, 1000]


def test_late_rate_without_main_rows(spark, arrivals):
    df = frame(spark, arrivals)
    row = reports.late_rate(df.limit(0), df).first()
    assert (row["main_cnt"], row["late_cnt"], row["late_pct"]) == (0, len(arrivals), None)


def test_histogram_puts_unknown_lateness_last(spark):
    rows = [(9_999, at(0)), (10_000, at(0)), (1_800_000, at(0)), (None, at(0)), (5, at(-4000))]
    df = spark.createDataFrame(rows, "late_ms bigint, etl_time timestamp")
    found = reports.late_histogram(df, at(1)).collect()
    assert sorted((row["late_bucket"], row["cnt"]) for row in found) == [("10s ~ 30s", 1), ("< 10s", 1), ("> 30min", 2)]


def test_alert_needs_consecutive_buckets(spark):
    def rows(*counts):
        return spark.createDataFrame([(at(h * 3600),) for h, n in enumerate(counts) for _ in range(n)], "event_time timestamp")

    advice = reports.late_rate_alert(rows(100, 100, 100, 100, 100), rows(6, 6, 6, 3, 1)).collect()
    assert [row["advice"] for row in advice] == ["WIDEN_WATERMARK", "WIDEN_WATERMARK", "INVESTIGATE", "WIDEN_WATERMARK", "OK"]


def test_backfill_prefers_the_main_row(spark):
    columns = "user_id string, event_type string, device_id string, event_time timestamp, page string"
    rest = [F.lit(None).cast(t).alias(n) for n, t in [
        ("app_id", "string"), ("referrer", "string"), ("product_id", "string"), ("duration_ms", "bigint"), ("ip", "string"),
        ("os_type", "string"), ("os_version", "string"), ("net_type", "string"), ("ext_json", "string")]]
    main = spark.createDataFrame([("u", "view", None, at(0), "main")], columns).select("*", *rest)
    other = spark.createDataFrame([("u", "view", None, at(0), "late"), ("u", "view", "D", at(0), "late")], columns).select("*", *rest)
    both = quality.late_backfill(main, other)
    assert sorted((row["device_id"] or "", row["page"]) for row in both.collect()) == [("", "main"), ("D", "late")]
    assert set(DEDUP_KEY) <= set(both.columns)
