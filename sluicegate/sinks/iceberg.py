"""An Iceberg table as the lake: the statements and reads for it.

The Iceberg connector is not part of this library; the cluster's catalog brings it. Here are only the texts that Spark SQL
runs against such a catalog, and the writer calls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluicegate import constants as C
from sluicegate.operators.cdc import latest_per_key, to_lake_row
from sluicegate.schema import LAKE_COLUMNS
from sluicegate.sinks.lake import bloom_filter_columns


def table_properties() -> dict[str, str]:
    """File sizes and Bloom filters of the lake table, as table properties."""
    blooms = {f"write.parquet.bloom-filter-enabled.column.{option.rpartition('#')[2]}": "true" for option in bloom_filter_columns()}
    return {"write.target-file-size-bytes": str(C.TARGET_FILE_BYTES), "write.parquet.compression-codec": "zstd", **blooms}


def create_statement(table: str, columns: str) -> str:
    properties = ", ".join(f"'{key}' = '{value}'" for key, value in table_properties().items())
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING iceberg PARTITIONED BY (dt) TBLPROPERTIES ({properties})"


def match_condition(key: tuple[str, ...] = ("dt", *C.DEDUP_KEY)) -> str:
    return " AND ".join(f"t.{name} <=> s.{name}" for name in key)


#: A stored row gives way to a change that is not older.
NEWER = "(t.op_ts IS NULL OR s.op_ts >= t.op_ts)"


def merge_statement(table: str, source: str, key: tuple[str, ...] = ("dt", *C.DEDUP_KEY)) -> str:
    """Apply the newest change of each key in ``source``; an older change never wins.

    A delete stays in the table as a row whose ``op_type`` is ``D``, also where it comes first: an older update that is delayed
    finds it and is passed over. :func:`current` hides these rows, :func:`purge_statement` removes old ones.
    """
    updates = ", ".join(f"t.{name} = s.{name}" for name in LAKE_COLUMNS)
    names, values = ", ".join(LAKE_COLUMNS), ", ".join(f"s.{name}" for name in LAKE_COLUMNS)
    return (
        f"MERGE INTO {table} AS t USING {source} AS s ON {match_condition(key)} "
        f"WHEN MATCHED AND {NEWER} THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def purge_statement(table: str, older_than: str) -> str:
    """Forget deletes from before ``older_than``; no change older than that may still come."""
    return f"DELETE FROM {table} WHERE op_type = 'D' AND op_ts < TIMESTAMP '{older_than}'"


def rewrite_statement(catalog: str, table: str, where: str | None = None, min_input_files: int = C.MIN_INPUT_FILES) -> str:
    """Compact small files; ``where`` restricts it to some days."""
    chosen = f", where => '{where.replace(chr(39), chr(39) * 2)}'" if where else ""
    options = f"map('target-file-size-bytes', '{C.TARGET_FILE_BYTES}', 'min-input-files', '{min_input_files}')"
    return f"CALL {catalog}.system.rewrite_data_files(table => '{table}', options => {options}{chosen})"


def expire_statement(catalog: str, table: str, older_than: str, retain_last: int = C.SNAPSHOT_RETAIN_LAST) -> str:
    return f"CALL {catalog}.system.expire_snapshots(table => '{table}', older_than => TIMESTAMP '{older_than}', retain_last => {retain_last})"


def orphans_statement(catalog: str, table: str, older_than: str, dry_run: bool = True) -> str:
    """List (or, without ``dry_run``, remove) files that no snapshot knows."""
    return (
        f"CALL {catalog}.system.remove_orphan_files(table => '{table}', older_than => TIMESTAMP '{older_than}', "
        f"dry_run => {str(dry_run).lower()})"
    )


def append(rows: DataFrame, table: str) -> None:
    rows.select(*LAKE_COLUMNS).writeTo(table).append()


def merge(spark: SparkSession, table: str, changes: DataFrame, arrival: str | tuple[str, ...] = "arrival") -> None:
    """Bring a batch of changes into the table; of a key the newest change of the batch counts."""
    view = f"_lake_changes_{uuid.uuid4().hex}"  # streams of one session merge at the same time
    to_lake_row(latest_per_key(changes, arrival)).createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view))
    finally:
        spark.catalog.dropTempView(view)


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table without its deleted rows."""
    return spark.table(table).where("op_type IS NULL OR op_type <> 'D'")


def files(spark: SparkSession, table: str) -> DataFrame:
    """The live files with day and size, in the shape that :mod:`sluicegate.plans.upkeep` reads."""
    return spark.sql(f"SELECT partition.dt AS dt, file_path, file_size_in_bytes FROM {table}.files")


def snapshots(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT snapshot_id, committed_at, operation, summary FROM {table}.snapshots")
