"""Relational sinks: a staging table written by Spark, then one keyed statement in the database.

Tasks commit on their own, so a retried task or a repeated micro-batch would insert rows twice.
The staging table is replaced as a whole, and the statement that moves its rows skips keys that
are there already; both may be repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY, JDBC_BATCH_ROWS, JDBC_MAX_RETRIES
from sluicegate.schema import LATE_COLUMNS, MAIN_COLUMNS


def main_table_rows(events: DataFrame, etl_time: Column | None = None) -> DataFrame:
    """The 15 columns of the main table; an absent duration is stored as 0."""
    return _table_rows(events, etl_time).select(*MAIN_COLUMNS)


def late_table_rows(late: DataFrame, etl_time: Column | None = None) -> DataFrame:
    """The 17 columns of the late table; lateness and watermark stay NULL where unknown."""
    return _table_rows(late, etl_time).select(*LATE_COLUMNS)


def _table_rows(events: DataFrame, etl_time: Column | None) -> DataFrame:
    return events.withColumns(
        {
            "duration_ms": F.coalesce("duration_ms", F.lit(0).cast("bigint")),
            "etl_time": F.current_timestamp() if etl_time is None else etl_time,
        }
    )


def merge_statement(
    table: str, staging: str, columns: tuple[str, ...], key: tuple[str, ...] = DEDUP_KEY, null_safe: str | None = None
) -> str:
    """Move staged rows whose key is not stored yet; null key parts match each other.

    ``null_safe`` is the database's own operator for that, ``<=>`` or ``IS NOT DISTINCT FROM``; with it the key's index serves.
    """
    names = ", ".join(columns)
    staged = ", ".join(f"s.{name}" for name in columns)
    plain = "(t.{0} = s.{0} OR (t.{0} IS NULL AND s.{0} IS NULL))"
    same = " AND ".join((f"t.{name} {null_safe} s.{name}" if null_safe else plain.format(name)) for name in key)
    return (
        f"INSERT INTO {table} ({names}) SELECT {staged} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})"
    )


def jdbc_writer(rows: DataFrame, options: dict[str, str], table: str):
    return (
        rows.write.format("jdbc")
        .mode("overwrite")
        .options(**options)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("batchsize", JDBC_BATCH_ROWS)
    )


def write_jdbc(
    rows: DataFrame,
    options: dict[str, str],
    table: str,
    execute: Callable[[str], object],
    key: tuple[str, ...] = DEDUP_KEY,
    connections: int | None = None,
    retries: int = JDBC_MAX_RETRIES,
    null_safe: str | None = None,
) -> None:
    """Stage rows, then run :func:`merge_statement` through ``execute`` (one transaction of the caller's driver).

    ``connections`` bounds the sessions opened at a time: rows of more tasks are gathered in so many, fewer tasks
    are left as they are. Repeats of a key inside the batch are staged once.
    """
    rows = rows.dropDuplicates(list(key))
    staging = f"{table}_stage"
    statement = merge_statement(table, staging, tuple(rows.columns), key, null_safe)
    for attempt in range(retries + 1):
        try:
            jdbc_writer(rows.coalesce(connections) if connections else rows, options, staging).save()
            execute(statement)
            return
        except Exception:
            if attempt == retries:
                raise


def write_main_jdbc(events: DataFrame, options: dict[str, str], table: str, execute: Callable[[str], object]) -> None:
    write_jdbc(main_table_rows(events), options, table, execute)


def write_late_jdbc(late: DataFrame, options: dict[str, str], table: str, execute: Callable[[str], object]) -> None:
    """Late rows may repeat a key on purpose, so a row is only skipped when it is the same in its lateness as well."""
    write_jdbc(late_table_rows(late), options, table, execute, key=(*DEDUP_KEY, "late_ms", "source_watermark"))
