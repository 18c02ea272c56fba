"""Change envelopes."""

import json

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import cdc

ROW = {"user_id": "U1", "event_type": "pay", "event_time": "2025-11-11 09:30:00", "app_id": "h5", "device_id": "D1"}


def envelope(op="c", ts_ms=1762853400123, **images):
    return json.dumps({"op": op, "before": None, "after": None, **images, "ts_ms": ts_ms})


CASES = {
    "create": (envelope(after=ROW), "I", None, None),
    "snapshot": (envelope("r", after=ROW), "I", None, None),
    "update": (envelope("u", before=ROW, after=ROW), "U", None, None),
    "delete": (envelope("d", before=ROW), "D", None, None),
    "old_time_passes": (envelope(after={**ROW, "event_time": "1999-01-01 00:00:00"}), "I", None, None),
    "blank": (" ", None, "EMPTY_JSON", None),
    "null_word": ("null", None, "EMPTY_JSON", None),
    "array": ("[1]", None, "PARSE_ERROR", "not a JSON object"),
    "truncated": (envelope(after=ROW)[:-2], None, "PARSE_ERROR", "not a JSON object"),
    "empty_object": ("{}", None, "UNKNOWN_OP", "null"),
    "other_op": (envelope("t", after=ROW), None, "UNKNOWN_OP", "t"),
    "delete_without_before": (envelope("d", after=ROW), None, "NO_DATA_FIELD", None),
    "update_without_after": (envelope("u", before=ROW), None, "NO_DATA_FIELD", None),
    "empty_image": (envelope(after={}), None, "MISSING_FIELDS", None),
    "blank_user": (envelope(after={**ROW, "user_id": " "}), None, "MISSING_FIELDS", None),
    "bad_time": (envelope(after={**ROW, "event_time": "x"}), None, "INVALID_EVENT_TIME", "x"),
    "bad_app": (envelope(after={**ROW, "app_id": "pc"}), None, "INVALID_APP_ID", "pc"),
    "bad_duration": (envelope(after={**ROW, "duration_ms": "x"}), None, "INVALID_DURATION", "x"),
}


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = [(name, case[0]) for name, case in CASES.items()]
    tagged = cdc.cdc_parse_clean(spark.createDataFrame(rows, "name string, raw string"))
    return {row["name"]: row for row in tagged.collect()}


@pytest.mark.parametrize("name", CASES)
def test_verdict(verdicts, name):
    _, op_type, reason, detail = CASES[name]
    row = verdicts[name]
    assert (row["reason"], row["detail"]) == (reason, detail)
    if reason is None:
        assert row["op_type"] == op_type and row["user_id"] == "U1"


def changes(spark, *rows):
    envelopes = spark.createDataFrame([(i, raw) for i, raw in enumerate(rows)], "arrival bigint, raw string")
    return cdc.cdc_clean_rows(cdc.cdc_parse_clean(envelopes, key_moves=True), ("arrival",))


def test_source_time_and_extra_fields(spark):
    with_extra = {**ROW, "coupon": "C"}
    row = changes(spark, envelope("d", before=with_extra, after={"other": 1})).first()
    assert row["ext_json"] == '{"coupon":"C"}' and row["duration_ms"] is None
    assert row["op_ts"].microsecond == 123000
    assert changes(spark, envelope(after=ROW, ts_ms=None)).first()["op_ts"] is None


def test_latest_state(spark):
    def at(ts, op, page):
        return envelope(op, ts, before={**ROW, "page": page}, after={**ROW, "page": page})

    assert cdc.cdc_latest_state(changes(spark, at(2, "u", "new"), at(1, "u", "old"))).first()["page"] == "new"
    assert cdc.cdc_latest_state(changes(spark, at(1, "c", "a"), at(2, "d", "a"))).isEmpty()
    assert cdc.cdc_latest_state(changes(spark, at(2, "d", "a"), at(1, "u", "a"))).isEmpty()
    stones = cdc.cdc_latest_state(changes(spark, at(1, "c", "a"), at(2, "d", "a")), keep_tombstones=True)
    assert [row["op_type"] for row in stones.collect()] == ["D"]
    assert cdc.cdc_latest_state(changes(spark, at(1, "u", "first"), at(1, "u", "second"))).first()["page"] == "second"


def test_first_seen_keeps_deletes(spark):
    rows = changes(spark, envelope("d", before=ROW), envelope("u", before=ROW, after=ROW))
    assert [row["op_type"] for row in cdc.cdc_first_seen(rows).collect()] == ["D"]


def test_update_that_moves_the_key(spark):
    moved = {**ROW, "event_time": "2025-11-12 00:00:00"}
    rows = changes(spark, envelope(after=ROW, ts_ms=1), envelope("u", 2, before=ROW, after=moved))
    assert sorted(row["op_type"] for row in rows.collect()) == ["D", "I", "U"]
    state = cdc.cdc_latest_state(rows).select(F.col("event_time").cast("string")).collect()
    assert [row[0] for row in state] == ["2025-11-12 00:00:00"]
    same = changes(spark, envelope("u", before={**ROW, "event_time": "2025-11-11T09:30:00"}, after=ROW))
    assert [row["op_type"] for row in cdc.cdc_latest_state(same).collect()] == ["U"]
