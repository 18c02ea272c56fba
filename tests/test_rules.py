"""Cleaning rules, one message each, with the verdict the rules give."""

import json

import pytest
from pyspark.sql import functions as F

from sluicegate.operators.clean import clean_events, clean_events_lenient, clean_rows, dirty_records

AS_OF = "2025-11-12 00:00:00"
GOOD = {
    "user_id": "U7", "event_type": "view", "event_time": "2025-11-11 09:30:00", "app_id": "mall_app",
    "device_id": "D1", "page": "/home", "duration_ms": 5200, "os_version": "13.0",
}


def message(**changes):
    return json.dumps({key: value for key, value in {**GOOD, **changes}.items() if value is not ...})


CASES = {
    # clean
    "plain": (message(), None, None),
    "t_separator": (message(event_time="2025-11-11T09:30:10"), None, None),
    "nine_digit_fraction": (message(event_time="2025-11-11 09:30:00.123456789"), None, None),
    "text_after_seconds": (message(event_time="2025-11-11 09:30:00 "), None, None),
    "first_allowed_time": (message(event_time="2020-01-01 00:00:00"), None, None),
    "last_allowed_time": (message(event_time="2025-11-12 01:00:00"), None, None),
    "no_duration": (message(duration_ms=...), None, None),
    "empty_duration": (message(duration_ms=""), None, None),
    "number_as_user": (message(user_id=17), None, None),
    "objects_in_array": (message(items=[{"a": 1}, {"a": 2}]), None, None),
    "bracket_in_text": (message(page="}]"), None, None),
    "surrounding_blanks": (" \t" + message() + "\n", None, None),
    # not one object
    "truncated": (message()[:-1], "PARSE_ERROR", "not a JSON object"),
    "array": ("[1]", "PARSE_ERROR", "not a JSON object"),
    "array_of_object": ("[" + message() + "]", "PARSE_ERROR", "not a JSON object"),
    "number": ("5", "PARSE_ERROR", "not a JSON object"),
    "string": ('"abc"', "PARSE_ERROR", "not a JSON object"),
    "trailing_text": (message() + " tail", "PARSE_ERROR", "not a JSON object"),
    "two_objects": (message() + "," + message(), "PARSE_ERROR", "not a JSON object"),
    "trailing_brace": (message() + "}", "PARSE_ERROR", "not a JSON object"),
    "trailing_bracket": (message() + "]", "PARSE_ERROR", "not a JSON object"),
    "bracket_and_more": (message() + "],[" + message(), "PARSE_ERROR", "not a JSON object"),
    "blank": ("", "PARSE_ERROR", "empty json"),
    "spaces": ("  ", "PARSE_ERROR", "empty json"),
    "null_word": ("null", "PARSE_ERROR", "empty json"),
    "absent": (None, "PARSE_ERROR", "empty json"),
    "empty_object": ("{}", "PARSE_ERROR", "empty json"),
    "spaced_empty_object": (" { } ", "PARSE_ERROR", "empty json"),
    # required fields
    "only_unknown_keys": ('{"x": 1}', "MISSING_FIELDS", "user_id event_type event_time "),
    "no_user": (message(user_id=...), "MISSING_FIELDS", "user_id "),
    "null_user": (message(user_id=None), "MISSING_FIELDS", "user_id "),
    "blank_user": (message(user_id="  "), "MISSING_FIELDS", "user_id "),
    "tab_user": (message(user_id="\t"), "MISSING_FIELDS", "user_id "),
    "no_type": (message(event_type=...), "MISSING_FIELDS", "event_type "),
    "no_time": (message(event_time=...), "MISSING_FIELDS", "event_time "),
    "two_missing": (message(event_time=..., user_id=""), "MISSING_FIELDS", "user_id event_time "),
    # time
    "no_seconds": (message(event_time="2025-11-11T09:30"), "INVALID_EVENT_TIME", "2025-11-11T09:30"),
    "no_such_day": (message(event_time="2025-02-30 00:00:00"), "INVALID_EVENT_TIME", "2025-02-30 00:00:00"),
    "hour_24": (message(event_time="2025-11-11 24:00:00"), "INVALID_EVENT_TIME", "2025-11-11 24:00:00"),
    "leading_space": (message(event_time=" 2025-11-11 09:30:00"), "INVALID_EVENT_TIME", " 2025-11-11 09:30:00"),
    "short_month": (message(event_time="2025-1-11 09:30:00"), "INVALID_EVENT_TIME", "2025-1-11 09:30:00"),
    "epoch_number": (message(event_time=1762853400), "INVALID_EVENT_TIME", "1762853400"),
    "one_second_too_old": (message(event_time="2019-12-31 23:59:59"), "EVENT_TIME_TOO_OLD", "2019-12-31 23:59:59"),
    "one_second_too_far": (message(event_time="2025-11-12 01:00:01"), "EVENT_TIME_FUTURE", "2025-11-12 01:00:01"),
    # application
    "other_app": (message(app_id="pc_web"), "INVALID_APP_ID", "pc_web"),
    "empty_app": (message(app_id=""), "INVALID_APP_ID", ""),
    "padded_app": (message(app_id=" h5"), "INVALID_APP_ID", " h5"),
    "no_app": (message(app_id=...), "INVALID_APP_ID", "null"),
    # number
    "word_duration": (message(duration_ms="soon"), "INVALID_DURATION", "soon"),
    "true_duration": (message(duration_ms=True), "INVALID_DURATION", "true"),
    # order of the rules
    "time_before_app": (message(event_time="x", app_id="pc_web"), "INVALID_EVENT_TIME", "x"),
    "missing_before_time": (message(user_id="", event_time="x"), "MISSING_FIELDS", "user_id "),
}


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [(name, raw) for name, (raw, _, _) in CASES.items()]
    return clean_events(spark.createDataFrame(rows, "name string, raw string"), AS_OF).cache()


@pytest.fixture(scope="module")
def verdicts(tagged):
    return {row["name"]: row for row in tagged.collect()}


@pytest.mark.parametrize("name", CASES)
def test_verdict(verdicts, name):
    _, reason, detail = CASES[name]
    row = verdicts[name]
    assert (row["verdict"], row["reason"], row["detail"]) == ("DIRTY" if reason else "CLEAN", reason, detail)


def test_clean_and_dirty_make_up_the_input(tagged):
    assert clean_rows(tagged).count() + dirty_records(tagged).count() == len(CASES)


def test_filtered_verdicts_equal_unfiltered_ones(tagged):
    assert {r["name"] for r in clean_rows(tagged, ("name",)).collect()} == {n for n, c in CASES.items() if not c[1]}


def test_dirty_text(tagged):
    texts = {row["name"]: row["dirty_text"] for row in dirty_records(tagged, ("name",)).collect()}
    assert texts["array"] == "[1] | PARSE_ERROR: not a JSON object"
    assert texts["empty_app"].endswith("} | INVALID_APP_ID: ")
    assert texts["absent"] == "null | PARSE_ERROR: empty json"
    assert texts["two_missing"].endswith(" | MISSING_FIELDS: user_id event_time ")


def one(spark, raw, **options):
    return clean_rows(clean_events(spark.createDataFrame([(raw,)], "raw string"), AS_OF, **options)).first()


@pytest.mark.parametrize(
    ("text", "number"),
    [("12.7", 12), ("9007199254740993", 9007199254740993), ('"31"', 31), ("-5", -5), ("null", 0), ('""', 0)],
)
def test_duration_text(spark, text, number):
    raw = message(duration_ms=0).replace('"duration_ms": 0', f'"duration_ms": {text}')
    assert one(spark, raw)["duration_ms"] == number


def test_absent_duration_by_mode(spark):
    assert one(spark, message(duration_ms=...))["duration_ms"] == 0
    assert one(spark, message(duration_ms=...), duration_default=None)["duration_ms"] is None


def test_trimming(spark):
    row = one(spark, message(user_id=" U1\t", event_type="\nview ", page=" /p "))
    assert (row["user_id"], row["event_type"], row["page"]) == ("U1", "view", " /p ")


@pytest.mark.parametrize(
    ("extra", "expected"),
    [
        ("", None),
        (', "trace_id": "T-1"', '{"trace_id":"T-1"}'),
        (', "z": 1, "a": "x"', '{"z":1,"a":"x"}'),
        (', "n": {"a": [1, "b"]}, "t": true', '{"n":{"a":[1,"b"]},"t":true}'),
        (', "x": null', "{}"),
        (', "x": null, "y": 2', '{"y":2}'),
        (', "x": 1, "x": 2', '{"x":2}'),
    ],
)
def test_ext_json(spark, extra, expected):
    assert one(spark, message()[:-1] + extra + "}")["ext_json"] == expected


def test_last_of_repeated_keys_counts(spark):
    assert one(spark, message()[:-1] + ', "user_id": "U8"}')["user_id"] == "U8"


def test_clock_of_the_query_by_default(spark):
    logs = spark.createDataFrame([(message(event_time="2099-01-01 00:00:00"),), (message(),)], "raw string")
    assert [r["reason"] for r in clean_events(logs).collect()] == ["EVENT_TIME_FUTURE", None]


def test_lenient_variant(spark):
    messages = {
        "plain": message(referrer="/r"), "blank_user": message(user_id=" "), "no_user": message(user_id=...),
        "old": message(event_time="1999-01-01 00:00:00"), "bad_app": message(app_id=" pc"), "bad_time": message(event_time="x"),
        "no_time": message(event_time=...), "broken": "{", "bad_duration": message(duration_ms="soon"), "no_app": message(app_id=...),
    }
    logs = spark.createDataFrame(list(messages.items()), "name string, raw string")
    kept = {row["name"]: row for row in clean_events_lenient(logs).collect()}
    assert set(kept) == {"plain", "blank_user", "old", "bad_app", "no_app"}
    assert kept["blank_user"]["user_id"] == "" and kept["bad_app"]["app_id"] == " pc"
    assert kept["plain"]["referrer"] is None and kept["plain"]["os_version"] is None


def test_text_is_parsed_once(spark):
    logs = spark.createDataFrame([(message(),)], "raw string")
    plan = clean_rows(clean_events(logs, AS_OF)).select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
