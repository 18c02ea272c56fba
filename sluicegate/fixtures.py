"""Raw logs and change envelopes derived from a plain ``events`` table.

Every column is arithmetic on ``event_id``, so the expected result of any operator can be
computed by SQL over ``events`` without reading JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.constants import VALID_APP_IDS

#: The clock used by batch queries.
AS_OF = "2030-01-01 00:00:00"
LATE_BASE = "2025-11-11 00:00:00"
LATE_SHIFTS = (12, 25, 50, 200, 1200, 3600)
ETL_BASE = "2026-01-01 00:00:00"
ETL_SPREAD_SECONDS = 4000


def _id() -> Column:
    return F.col("event_id")


def _event_fields(event_time: Column, key: Column) -> dict[str, Column]:
    return {
        "user_id": F.concat(F.lit("U"), (F.col("user_id") + 100000).cast("string")),
        "event_type": F.col("event_type"),
        "event_time": event_time,
        "app_id": F.get(F.array(*map(F.lit, VALID_APP_IDS)), (key % 3).cast("int")),
        "device_id": F.when(key % 17 != 0, F.concat(F.lit("DEV-"), (F.col("user_id") % 50).cast("string"))),
        "page": F.concat(F.lit("/page/"), (key % 7).cast("string")),
        "product_id": F.when(key % 2 == 0, F.concat(F.lit("P"), (key % 100).cast("string"))),
        "duration_ms": F.when(key % 11 != 0, F.round(F.col("value") * 100).cast("bigint")),
        "os_type": F.lit("Android"),
        "k": F.get_json_object("props", "$.k").cast("bigint"),
    }


def _as_struct(fields: dict[str, Column]) -> Column:
    return F.struct(*(column.alias(name) for name, column in fields.items()))


def _repeated(events: DataFrame) -> DataFrame:
    """Rows with ``event_id % 10 = 3`` twice; ``arrival`` counts the messages in order."""
    copies = F.when(_id() % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("_copy", F.explode(copies)).withColumn("arrival", _id() * 2 + F.col("_copy"))


def _time_text(time: Column) -> Column:
    """Every fourth row in the ``T`` form with a fraction, which the cleaning has to cut."""
    plain = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
    return F.when(_id() % 4 == 1, F.concat(F.replace(plain, F.lit(" "), F.lit("T")), F.lit(".123"))).otherwise(plain)


def raw_logs(events: DataFrame) -> DataFrame:
    """``arrival, arrived_at, raw``: one JSON text per message, a quarter of them broken in ten ways."""
    time = F.col("ts").cast("timestamp")
    fields = _event_fields(_time_text(time), _id())
    dirt = _id() % 40
    fields["user_id"] = F.when(dirt != 2, fields["user_id"])
    fields["event_type"] = F.when(dirt == 3, F.lit(" ")).otherwise(fields["event_type"])
    fields["event_time"] = (
        F.when(dirt == 4, F.lit(None))
        .when(dirt == 5, F.date_format(time, "yyyy-MM-dd HH:mm"))
        .when(dirt == 6, F.lit("1999-01-01 00:00:00"))
        .when(dirt == 7, F.lit("2099-11-11 00:00:00"))
        .otherwise(fields["event_time"])
    )
    fields["app_id"] = F.when(dirt == 8, "pc_web").when(dirt == 9, "").otherwise(fields["app_id"])
    text = F.to_json(_as_struct(fields))
    raw = (
        F.when(dirt == 0, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(dirt == 1, F.lit("{}"))
        .otherwise(text)
    )
    return _repeated(events).select("arrival", time.alias("arrived_at"), raw.alias("raw"))


def late_logs(events: DataFrame) -> DataFrame:
    """``arrival, batch_id, etl_time, raw``: one event per second, every fifth shifted into the past."""
    shifts = F.array(*map(F.lit, LATE_SHIFTS))
    shift = F.when(_id() % 5 == 0, F.get(shifts, (_id() / 5).cast("bigint").cast("int") % 6)).otherwise(F.lit(0))
    moved = F.timestamp_seconds(F.unix_timestamp(F.lit(LATE_BASE)) + _id() - shift)
    raw = F.to_json(_as_struct(_event_fields(_time_text(moved), _id())))
    loaded = F.timestamp_seconds(F.unix_timestamp(F.lit(ETL_BASE)) + _id() % ETL_SPREAD_SECONDS)
    return _repeated(events).select(
        "arrival", _id().alias("batch_id"), loaded.alias("etl_time"), raw.alias("raw")
    )


def returning(events: DataFrame) -> DataFrame:
    """``event_id, arrived_at`` and the four key columns: a third of the rows are one key without a pause, others come back during a day."""
    steady = _id() % 3 == 0
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("arrived_at"),
        F.when(steady, F.lit("HOT")).otherwise(F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string"))).alias("user_id"),
        F.when(steady, F.lit("view")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(~steady & (_id() % 17 != 0), F.concat(F.lit("DEV-"), (_id() % 2).cast("string"))).alias("device_id"),
        F.when(steady, F.lit(LATE_BASE).cast("timestamp")).otherwise(day).alias("event_time"),
    )


def cdc_envelopes(events: DataFrame) -> DataFrame:
    """``arrival, raw``: three changes per row ``r = event_id div 3``: create, update, then delete or update.

    The three events of a group differ in their values, so the key columns are taken from ``r``.
    """
    group = F.expr("event_id div 3")
    time = F.timestamp_seconds(F.unix_timestamp(F.lit(LATE_BASE)) + group)
    fields = _event_fields(F.date_format(time, "yyyy-MM-dd HH:mm:ss"), group)
    fields["user_id"] = F.concat(F.lit("U"), (group % 1000 + 100000).cast("string"))
    fields["event_type"] = F.get(F.array(*map(F.lit, ("view", "click", "pay"))), (group % 3).cast("int"))
    fields["device_id"] = F.when(group % 17 != 0, F.concat(F.lit("DEV-"), (group % 50).cast("string")))
    image = _as_struct(fields)
    deleted = (_id() % 3 == 2) & (group % 5 == 0)
    op = F.when(_id() % 3 == 0, "c").when(deleted, "d").otherwise("u")
    envelope = F.struct(
        op.alias("op"),
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        ((F.unix_timestamp(F.lit(LATE_BASE)) + _id()) * 1000).alias("ts_ms"),
    )
    return events.select(_id().alias("arrival"), F.to_json(envelope).alias("raw"))


def moving_envelopes(events: DataFrame) -> DataFrame:
    """``arrival, raw``: a create per event, then an update whose kind goes by ``event_id % 8``.

    0 a new user, 1 no row after, 2 a second object in the text, 3 a new user but a bad app, 4 the same key written otherwise,
    5 an unknown operation, 6 nothing but a bracket, 7 a snapshot of the same row.
    """
    kind = _id() % 8
    time = F.timestamp_seconds(F.unix_timestamp(F.lit(LATE_BASE)) + _id())
    fields = _event_fields(F.date_format(time, "yyyy-MM-dd HH:mm:ss"), _id())
    fields["user_id"] = F.concat(F.lit("M"), _id().cast("string"))
    old = _as_struct(fields)
    moved = _as_struct(fields | {"user_id": F.concat(F.lit("N"), _id().cast("string"))})
    other = _as_struct(fields | {"event_time": F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), "page": F.lit("/same")})
    bad = _as_struct(fields | {"user_id": F.concat(F.lit("N"), _id().cast("string")), "app_id": F.lit("pc")})
    after = F.when(kind == 0, moved).when(kind == 3, bad).when(kind == 4, other).when(kind != 1, moved)
    op = F.when(kind == 5, "t").when(kind == 7, "r").otherwise("u")
    seconds = F.unix_timestamp(F.lit(LATE_BASE)) + _id()

    def text(op: Column, before: Column, after: Column, ts: Column) -> Column:
        return F.to_json(F.struct(op.alias("op"), before.alias("before"), after.alias("after"), ts.alias("ts_ms")))

    none = F.lit(None).cast("string")
    create = text(F.lit("c"), none, old, seconds * 1000)
    update = text(op, old, F.when(kind == 7, old).otherwise(after), seconds * 1000 + 1)
    update = F.when(kind == 2, F.concat(update, update)).when(kind == 6, F.lit("]")).otherwise(update)
    both = events.select(_id().alias("_n"), F.posexplode(F.array(create, update)).alias("_k", "raw"))
    return both.select((F.col("_n") * 2 + F.col("_k")).alias("arrival"), "raw")


def file_listing(events: DataFrame) -> DataFrame:
    """A file listing: one file per day and 50th of the users, its size from the rows it would hold."""
    name = F.concat(F.lit("part-"), F.lpad((F.col("user_id") % 50).cast("string"), 2, "0"))
    files = events.groupBy(F.to_date("ts").alias("dt"), name.alias("_name")).agg(
        (F.sum(_id() % 997 + 1) * 400).alias("file_size_in_bytes")
    )
    number = F.substring("_name", 6, 2).cast("int")
    return files.select(
        "dt",
        F.concat(F.lit("dt="), F.col("dt").cast("string"), F.lit("/"), F.col("_name")).alias("file_path"),
        "file_size_in_bytes",
        F.concat(F.lit("c"), (number % 7).cast("string")).alias("commit_id"),
        F.col("dt").cast("timestamp").alias("modified_at"),
    )


def snapshot_listing(events: DataFrame) -> DataFrame:
    """A snapshot per hour of events."""
    committed = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("committed_at")
    hours = events.groupBy(committed).agg(F.min("event_id").alias("snapshot_id"), F.count(F.lit(1)).alias("_rows"))
    return hours.select(
        "snapshot_id",
        "committed_at",
        F.when(F.col("snapshot_id") % 4 == 0, "overwrite").otherwise("append").alias("operation"),
        F.create_map(F.lit("added-records"), F.col("_rows").cast("string")).alias("summary"),
    )
