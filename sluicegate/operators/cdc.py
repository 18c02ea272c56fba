"""Change-data envelopes: parse and clean, latest state per key, changes that move a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.functions.payload import (
    collect_ext_json,
    is_one_object,
    known_fields_ddl,
    parse_elements,
    typed_entries,
    unknown_entries,
    wrapped,
)
from sluicegate.functions.text import is_blank, strip, to_whole_number
from sluicegate.functions.times import parse_event_time
from sluicegate.operators import rules
from sluicegate.operators.clean import verdict_columns
from sluicegate.operators.dedup import dedup_first_seen, dedup_ttl
from sluicegate.schema import CDC_COLUMNS, LAKE_COLUMNS

BEFORE, AFTER = "before", "after"


def cdc_op_type(op: Column) -> Column:
    """I for a create or a snapshot read, U for an update, D for a delete, NULL for anything else."""
    code = F.lit(None).cast("string")
    for name, letter in C.OP_TYPES.items():
        code = F.when(op == name, letter).otherwise(code)
    return code


def cdc_row_image(op_type: Column, envelope: Column) -> Column:
    """The row a change speaks of: what was there for a delete, what is there otherwise."""
    return F.when(op_type == "D", envelope[BEFORE]).otherwise(envelope[AFTER])


def cdc_op_ts(ts_ms: Column) -> Column:
    return F.timestamp_millis(to_whole_number(ts_ms))


def _cdc_rules(raw: Column, elements: Column, envelope: Column, op_type: Column, image: Column, event_time: Column):
    nothing = is_blank(raw) | (strip(raw) == "null")
    no_detail = F.lit(None).cast("string")
    return [
        (F.coalesce(nothing, F.lit(False)), C.EMPTY_JSON, no_detail),
        (~is_one_object(raw, elements) | envelope.isNull(), C.PARSE_ERROR, F.lit("not a JSON object")),
        (op_type.isNull(), C.UNKNOWN_OP, F.coalesce(envelope["op"], F.lit("null"))),
        (image.isNull(), C.NO_DATA_FIELD, no_detail),
        *rules.rule_missing_fields(image, list_names=False),
        *rules.rule_invalid_event_time(image, event_time),
        *rules.rule_invalid_app_id(image),
        *rules.rule_invalid_duration(image),
    ]


def parse_envelopes(envelopes: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the envelope, its operation, the row image and its event time, parsed once per row."""
    image = f"struct<{known_fields_ddl()}>"
    fields = f"op: string, {BEFORE}: {image}, {AFTER}: {image}, ts_ms: string"
    elements = envelopes.select("*", parse_elements(F.col(raw), fields).alias("_elements"))
    opened = elements.select("*", F.get("_elements", F.lit(0)).alias("_envelope"))
    typed = opened.withColumn("_op_type", cdc_op_type(F.col("_envelope.op")))
    imaged = typed.withColumn("_image", cdc_row_image(F.col("_op_type"), F.col("_envelope")))
    parsed = F.struct(
        "_elements", "_envelope", "_op_type", "_image", parse_event_time(F.col("_image.event_time")).alias("_event_time")
    )
    return imaged.select(*envelopes.columns, F.explode_outer(F.array(parsed)).alias("_parsed")).select(
        *envelopes.columns, "_parsed.*"
    )


def cdc_parse_clean(envelopes: DataFrame, raw: str = "raw", key_moves: bool = False) -> DataFrame:
    """Tag change envelopes CLEAN or DIRTY and project the event columns, ``op_type`` and ``op_ts``.

    Event times of any age pass, an absent duration stays absent. With ``key_moves`` a clean update that changes a
    key column comes with a delete of the row under the old key, see :func:`with_key_moves`.
    """
    text = F.col(raw)
    images = typed_entries(
        envelopes, wrapped(text), f"array<struct<{BEFORE}: map<string, variant>, {AFTER}: map<string, variant>>>"
    )
    parsed = (
        parse_envelopes(envelopes, raw)
        .withColumn("_entries", F.get(images, F.lit(0)))
        .withColumn("_unknown", unknown_entries(cdc_row_image(F.col("_op_type"), F.col("_entries"))))
    )
    op_type, image, event_time = F.col("_op_type"), F.col("_image"), F.col("_event_time")
    why = rules.first_broken(_cdc_rules(text, F.col("_elements"), F.col("_envelope"), op_type, image, event_time))
    before = F.col("_envelope.before")
    before_time = parse_event_time(before["event_time"])
    old = F.when(
        (op_type == "U") & before.isNotNull() & ~is_blank(before["user_id"]) & ~is_blank(before["event_type"]) & before_time.isNotNull(),
        F.struct(*rules.project_known_fields(before, before_time, duration_default=None)),
    )
    tagged = parsed.withColumn("_why", why).select(
        *envelopes.columns,
        *rules.project_known_fields(image, event_time, duration_default=None),
        collect_ext_json(F.col("_unknown")).alias("ext_json"),
        op_type.alias("op_type"),
        cdc_op_ts(F.col("_envelope.ts_ms")).alias("op_ts"),
        *verdict_columns(F.col("_why")),
        *([old.alias("_old")] if key_moves else []),
    )
    return with_key_moves(tagged) if key_moves else tagged


def cdc_clean_rows(tagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return tagged.where(F.col("verdict") == "CLEAN").select(*keep, *CDC_COLUMNS)


def with_key_moves(tagged: DataFrame) -> DataFrame:
    """Put a delete of the old row beside every clean update that changes a key column.

    Without it the row under the old key would stay. ``_old`` holds the cleaned row before the change and is dropped.
    A rejected update moves nothing, as it is not applied; keys are compared as they are stored, after trimming and
    reading of times. Deletes carry time and arrival of their update and sort before other changes of that moment.
    """
    old = F.col("_old")
    same = F.lit(True)
    for name in C.DEDUP_KEY:
        same = same & old[name].eqNullSafe(F.col(name))
    moved = F.coalesce((F.col("verdict") == "CLEAN") & old.isNotNull() & ~same, F.lit(False))
    names = [name for name in tagged.columns if name != "_old"]
    fixed = {"op_type": F.lit("D"), "ext_json": F.lit(None).cast("string")}
    removal = F.struct(*((old[n] if n in C.KNOWN_FIELDS else fixed.get(n, F.col(n))).alias(n) for n in names))
    change = F.struct(*names)
    return tagged.select(F.explode(F.when(moved, F.array(removal, change)).otherwise(F.array(change))).alias("_row")).select("_row.*")


def newest_first(op_ts: str, arrival: str | tuple[str, ...]) -> list[Column]:
    """Newest change first: by source time, then arrival; of one arrival the non-delete is the newer."""
    return [
        F.col(op_ts).desc_nulls_last(),
        *(F.col(name).desc() for name in ((arrival,) if isinstance(arrival, str) else arrival)),
        (F.col("op_type") == "D").asc(),
    ]


def latest_per_key(changes: DataFrame, arrival: str | tuple[str, ...] = "arrival", key: tuple[str, ...] = C.DEDUP_KEY) -> DataFrame:
    """The newest change of every key, deletes included; losers are dropped before the shuffle."""
    newest = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first("op_ts", arrival)))
    return changes.withColumn("_nth", newest).where(F.col("_nth") == 1).drop("_nth")


def cdc_latest_state(
    changes: DataFrame,
    arrival: str | tuple[str, ...] = "arrival",
    key: tuple[str, ...] = C.DEDUP_KEY,
    keep_tombstones: bool = False,
) -> DataFrame:
    """Upsert semantics: an update replaces the row, a delete removes it (or stays as a tombstone)."""
    latest = latest_per_key(changes, arrival, key)
    return latest if keep_tombstones else latest.where(F.col("op_type") != "D")


def cdc_first_seen(
    changes: DataFrame, arrival: str = "arrival", arrived_at: str | None = None, ttl_ms: int = C.DEDUP_TTL_MS
) -> DataFrame:
    """First change of every key whatever its kind; a delete stays as a row.

    With the time of arrival, keys are forgotten a period after the change that was kept, so one that returns later is kept again.
    """
    if arrived_at is None:
        return dedup_first_seen(changes, arrival)
    return dedup_ttl(changes, arrived_at, arrival, ttl_ms=ttl_ms)


def to_lake_row(changes: DataFrame, etl_time: Column | None = None) -> DataFrame:
    """The lake table's columns by name, with the load time and the event date."""
    return changes.select(
        *CDC_COLUMNS,
        (F.current_timestamp() if etl_time is None else etl_time).alias("etl_time"),
        F.to_date("event_time").alias("dt"),
    ).select(*LAKE_COLUMNS)
