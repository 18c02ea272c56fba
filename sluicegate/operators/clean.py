"""Cleaning of raw event logs: one pass tags every row, the branches are filters on the tag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.functions.payload import (
    collect_ext_json,
    known_fields_ddl,
    parse_elements,
    typed_entries,
    unknown_entries,
)
from sluicegate.functions.times import as_instant, parse_event_time
from sluicegate.operators import rules
from sluicegate.schema import EVENT_COLUMNS

CLEAN = "CLEAN"
DIRTY = "DIRTY"
TAG_COLUMNS = ("verdict", "reason", "detail")


def verdict_columns(why: Column) -> list[Column]:
    return [
        F.when(why.isNull(), CLEAN).otherwise(DIRTY).alias("verdict"),
        why["reason"].alias("reason"),
        why["detail"].alias("detail"),
    ]


def parse_once(logs: DataFrame, raw: str) -> DataFrame:
    """Add the parsed objects, the first one's fields and its event time.

    A filter on the verdict would be pushed down to the scan and the parse copied into it once
    per use. Filters do not move below an explode, so exploding a single-element array keeps
    the parse in one place; the row count does not change.
    """
    elements = logs.select("*", parse_elements(F.col(raw), known_fields_ddl()).alias("_elements"))
    fields = elements.select("*", F.get("_elements", F.lit(0)).alias("_fields"))
    parsed = F.struct("_elements", "_fields", parse_event_time(F.col("_fields.event_time")).alias("_event_time"))
    return fields.select(*logs.columns, F.explode_outer(F.array(parsed)).alias("_parsed")).select(
        *logs.columns, "_parsed.*"
    )


def clean_events(
    logs: DataFrame,
    as_of: str | dt.datetime | Column | None = None,
    raw: str = "raw",
    duration_default: int | None = 0,
    max_future_seconds: int = C.MAX_FUTURE_SECONDS,
) -> DataFrame:
    """Tag every raw row CLEAN or DIRTY and project the event columns.

    The raw text and all other input columns are kept. ``as_of`` is the clock for the
    future check; leave it out in streams. Unknown keys are only collected where
    ``ext_json`` is read downstream.
    """
    text = F.col(raw)
    carried = [F.col(name) for name in logs.columns]
    fields = parse_once(logs, raw).withColumn(
        "_unknown", unknown_entries(typed_entries(logs, text))
    )
    row, event_time = F.col("_fields"), F.col("_event_time")
    why = rules.first_broken(
        [
            *rules.rule_parse_error(text, F.col("_elements"), row),
            *rules.rule_missing_fields(row),
            *rules.rule_invalid_event_time(row, event_time),
            *rules.rule_event_time_too_old(row, event_time),
            *rules.rule_event_time_future(row, event_time, as_instant(as_of), max_future_seconds),
            *rules.rule_invalid_app_id(row),
            *rules.rule_invalid_duration(row),
        ]
    )
    return fields.withColumn("_why", why).select(
        *carried,
        *rules.project_known_fields(row, event_time, duration_default),
        collect_ext_json(F.col("_unknown")).alias("ext_json"),
        *verdict_columns(F.col("_why")),
    )


def clean_rows(tagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The main output: clean rows with the event columns, plus the columns named in ``keep``."""
    return tagged.where(F.col("verdict") == CLEAN).select(*keep, *EVENT_COLUMNS)


def dirty_text(raw: Column, reason: Column, detail: Column) -> Column:
    """``raw | REASON: detail``; the colon part only where there is a detail."""
    return F.concat(
        F.coalesce(raw, F.lit("null")),
        F.lit(" | "),
        reason,
        F.coalesce(F.concat(F.lit(": "), detail), F.lit("")),
    )


def dirty_records(tagged: DataFrame, keep: tuple[str, ...] = (), raw: str = "raw") -> DataFrame:
    """The side output: rejected rows with their reason, and the user when it parsed."""
    return tagged.where(F.col("verdict") == DIRTY).select(
        *keep,
        raw,
        "user_id",
        "reason",
        "detail",
        dirty_text(F.col(raw), F.col("reason"), F.col("detail")).alias("dirty_text"),
    )


def clean_events_lenient(logs: DataFrame, raw: str = "raw") -> DataFrame:
    """Drop-only variant: fields must exist (blank passes) and the time must parse; nothing else is checked.

    It knows no referrer, os_version or extra fields, and leaves app_id untrimmed.
    """
    text = F.col(raw)
    carried = [F.col(name) for name in logs.columns if name != raw]
    fields = parse_once(logs, raw)
    row, event_time = F.col("_fields"), F.col("_event_time")
    present = F.lit(True)
    for name in ("user_id", "event_type"):
        present = present & row[name].isNotNull()
    unreadable = [*rules.rule_parse_error(text, F.col("_elements"), row), *rules.rule_invalid_duration(row)]
    kept = fields.where(present & event_time.isNotNull() & rules.first_broken(unreadable).isNull())
    absent = ("referrer", "os_version")
    known = dict(zip(C.KNOWN_FIELDS, rules.project_known_fields(row, event_time, duration_default=0)))
    known["app_id"] = row["app_id"].alias("app_id")
    for name in absent:
        known[name] = F.lit(None).cast("string").alias(name)
    return kept.select(*carried, *known.values(), F.lit(None).cast("string").alias("ext_json"))

