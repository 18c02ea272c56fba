"""The ordered cleaning rules. The first rule a row breaks decides its reason and detail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.functions.payload import is_one_object
from sluicegate.functions.text import is_blank, is_number_or_absent, strip, to_whole_number
from sluicegate.functions.times import plus_ms

Rule = tuple[Column, str, Column]


def _no_detail() -> Column:
    return F.lit(None).cast("string")


def rule_parse_error(raw: Column, elements: Column, parsed: Column) -> list[Rule]:
    """Not exactly one JSON object; nothing at all, ``null`` and ``{}`` count as empty."""
    # Blank text reads as no element at all, the word null as one element that is null.
    nothing = raw.isNull() | (F.size(elements) == 0) | ((F.size(elements) == 1) & parsed.isNull())
    # Only a row without any required field can be an empty object, so few rows are looked at twice.
    no_keys = F.when(
        parsed["user_id"].isNull() & parsed["event_type"].isNull() & parsed["event_time"].isNull(),
        F.size(F.json_object_keys(raw)) == 0,
    )
    return [
        (F.coalesce(nothing, F.lit(False)), C.PARSE_ERROR, F.lit("empty json")),
        (~is_one_object(raw, elements), C.PARSE_ERROR, F.lit("not a JSON object")),
        (F.coalesce(no_keys, F.lit(False)), C.PARSE_ERROR, F.lit("empty json")),
    ]


def rule_missing_fields(parsed: Column, list_names: bool = True) -> list[Rule]:
    """A required field is null or blank; the detail lists all of them, each followed by a space."""
    names = F.concat(
        *(F.when(is_blank(parsed[name]), F.lit(f"{name} ")).otherwise(F.lit("")) for name in C.REQUIRED_FIELDS)
    )
    return [(names != "", C.MISSING_FIELDS, names if list_names else _no_detail())]


def rule_invalid_event_time(parsed: Column, event_time: Column) -> list[Rule]:
    return [(event_time.isNull(), C.INVALID_EVENT_TIME, parsed["event_time"])]


def rule_event_time_too_old(parsed: Column, event_time: Column) -> list[Rule]:
    bound = F.lit(C.MIN_EVENT_TIME).cast("timestamp")
    return [(event_time < bound, C.EVENT_TIME_TOO_OLD, parsed["event_time"])]


def rule_event_time_future(
    parsed: Column, event_time: Column, as_of: Column, max_future_seconds: int = C.MAX_FUTURE_SECONDS
) -> list[Rule]:
    bound = plus_ms(as_of, max_future_seconds * 1000)
    return [(event_time > bound, C.EVENT_TIME_FUTURE, parsed["event_time"])]


def rule_invalid_app_id(parsed: Column) -> list[Rule]:
    """Checked untrimmed; an absent value prints as ``null``."""
    allowed = F.coalesce(parsed["app_id"].isin(*C.VALID_APP_IDS), F.lit(False))
    return [(~allowed, C.INVALID_APP_ID, F.coalesce(parsed["app_id"], F.lit("null")))]


def rule_invalid_duration(parsed: Column) -> list[Rule]:
    return [(~is_number_or_absent(parsed["duration_ms"]), C.INVALID_DURATION, parsed["duration_ms"])]


def first_broken(rules: list[Rule]) -> Column:
    """``struct<reason, detail>`` of the first broken rule, NULL when the row is clean."""
    verdict = F.when(F.lit(False), F.struct(F.lit("").alias("reason"), _no_detail().alias("detail")))
    for broken, reason, detail in rules:
        verdict = verdict.when(broken, F.struct(F.lit(reason).alias("reason"), detail.alias("detail")))
    return verdict


def project_known_fields(parsed: Column, event_time: Column, duration_default: int | None) -> list[Column]:
    """The 13 known columns: three trimmed, one time, one number, the rest as they came."""
    trimmed = {"user_id", "event_type", "app_id"}

    def column(name: str) -> Column:
        if name == "event_time":
            return event_time
        if name == "duration_ms":
            number = to_whole_number(parsed[name])
            return number if duration_default is None else F.coalesce(number, F.lit(duration_default).cast("bigint"))
        return strip(parsed[name]) if name in trimmed else parsed[name]

    return [column(name).alias(name) for name in C.KNOWN_FIELDS]
