"""Column lists and table schemas, all taken from one description of the event."""

from __future__ import annotations

from pyspark.sql import types as T

from sluicegate.constants import KNOWN_FIELDS

_TYPES = {"event_time": T.TimestampType(), "duration_ms": T.LongType()}
_NOT_NULL = {"user_id", "event_type", "event_time", "app_id"}


def _field(name: str) -> T.StructField:
    return T.StructField(name, _TYPES.get(name, T.StringType()), name not in _NOT_NULL)


EVENT = T.StructType([*(_field(name) for name in KNOWN_FIELDS), T.StructField("ext_json", T.StringType())])
EVENT_COLUMNS = tuple(EVENT.fieldNames())

_ETL_TIME = T.StructField("etl_time", T.TimestampType())

MAIN = T.StructType([*EVENT.fields, _ETL_TIME])
LATE = T.StructType(
    [
        *EVENT.fields,
        T.StructField("late_ms", T.LongType()),
        T.StructField("source_watermark", T.TimestampType()),
        _ETL_TIME,
    ]
)
CDC_EVENT = T.StructType(
    [*EVENT.fields, T.StructField("op_type", T.StringType()), T.StructField("op_ts", T.TimestampType())]
)
LAKE = T.StructType([*CDC_EVENT.fields, _ETL_TIME, T.StructField("dt", T.DateType())])

MAIN_COLUMNS = tuple(MAIN.fieldNames())
LATE_COLUMNS = tuple(LATE.fieldNames())
CDC_COLUMNS = tuple(CDC_EVENT.fieldNames())
LAKE_COLUMNS = tuple(LAKE.fieldNames())


def nullable(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as Parquet readers report it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
