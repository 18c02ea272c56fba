"""Relational sinks without a database, catalog tables, readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluicegate.operators.clean import clean_events, clean_rows
from sluicegate.schema import LAKE_COLUMNS, LATE_COLUMNS, MAIN_COLUMNS
from sluicegate.sinks import jdbc, tables
from sluicegate.sources import logs
from sluicegate.sources.tables import filter_partition, read_ods_table
from sluicegate.plans.reports import between_events

RAW = '{"user_id":"u","event_type":"view","event_time":"2025-11-11 00:00:00","app_id":"h5"}'


@pytest.fixture
def events(spark):
    return clean_rows(clean_events(spark.createDataFrame([(RAW,)], "raw string"), duration_default=None))


def test_table_columns(events):
    assert events.first()["duration_ms"] is None
    main = jdbc.main_table_rows(events)
    assert tuple(main.columns) == MAIN_COLUMNS and len(MAIN_COLUMNS) == 15
    assert main.first()["duration_ms"] == 0 and main.first()["etl_time"] is not None
    unknown = events.withColumns({"late_ms": F.lit(None).cast("bigint"), "source_watermark": F.lit(None).cast("timestamp")})
    late = jdbc.late_table_rows(unknown)
    assert tuple(late.columns) == LATE_COLUMNS and len(LATE_COLUMNS) == 17
    assert late.first()["late_ms"] is None and len(LAKE_COLUMNS) == 18


def test_staging_then_one_statement(events, monkeypatch):
    steps = []

    class Writer:
        def save(self):
            steps.append("stage")
            if len(steps) == 1:
                raise OSError("connection lost")

    monkeypatch.setattr(jdbc, "jdbc_writer", lambda rows, options, table: Writer())
    jdbc.write_main_jdbc(events, {"url": "jdbc:x"}, "main", steps.append)
    assert steps[:2] == ["stage", "stage"] and len(steps) == 3
    assert steps[2].startswith("INSERT INTO main (user_id, event_type") and "FROM main_stage s WHERE NOT EXISTS" in steps[2]
    assert "(t.device_id = s.device_id OR (t.device_id IS NULL AND s.device_id IS NULL))" in steps[2]


def test_retries_are_bounded(events, monkeypatch):
    calls = []

    def failing(statement):
        calls.append(statement)
        raise OSError

    class Writer:
        def save(self):
            pass

    monkeypatch.setattr(jdbc, "jdbc_writer", lambda *_: Writer())
    with pytest.raises(OSError):
        jdbc.write_main_jdbc(events, {}, "main", failing)
    assert len(calls) == 4


def test_catalog_tables(spark, events):
    tables.create_tables(spark, "gate")
    spark.sql("USE gate")
    try:
        jdbc.main_table_rows(events).write.mode("append").insertInto("gate.user_action_main")
        assert read_ods_table(spark, "gate.user_action_main").count() == 1
        assert read_ods_table(spark, "gate.user_action_late").columns == list(LATE_COLUMNS)
        lake = read_ods_table(spark, "gate.user_action_lake")
        assert lake.columns == list(LAKE_COLUMNS)
        assert spark.catalog.listColumns("gate.user_action_lake")[-1].isPartition
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE gate CASCADE")


def test_kafka_values(spark):
    record = [(b"k", RAW.encode(), "t", 3, 17, dt.datetime(2025, 11, 11))]
    df = spark.createDataFrame(record, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    row = logs.kafka_to_raw(df).first()
    assert (row["raw"], row["partition"], row["arrival"]) == (RAW, 3, 17)
    empty = spark.createDataFrame([("",), (None,), ("{}",)], "raw string")
    assert logs.without_empty(empty).count() == 1


def test_dated_reads_prune(spark, events, root):
    events.withColumn("dt", F.to_date("event_time")).write.partitionBy("dt").parquet(root)
    table = read_ods_table(spark, root)
    assert filter_partition(table, "2025-11-11").count() == 1
    assert filter_partition(table, "2025-11-12").count() == 0
    ranged = between_events(table, "2025-11-11 00:00:00", "2025-11-12 00:00:00")
    scan = ranged._jdf.queryExecution().executedPlan().toString()
    assert ranged.count() == 1 and "(dt#" in scan.split("PartitionFilters")[1]


def test_repeated_batch_replaces_its_folder(spark, events, root):
    for _ in range(2):
        tables.write_batch(events, root, 5)
    tables.write_batch(events, root, 6)
    assert spark.read.parquet(root).count() == 2


def test_null_safe_operator_of_the_database():
    text = jdbc.merge_statement("t_main", "t_stage", ("user_id", "device_id"), ("device_id",), null_safe="<=>")
    assert text.endswith("WHERE t.device_id <=> s.device_id)")


def test_jobs_say_what_they_need(spark, root):
    from sluicegate.streaming import main

    with pytest.raises(SystemExit, match="needs --topic"):
        main.run(spark, main.parser().parse_args(["logs", "--root", root]))
    with pytest.raises(SystemExit, match="needs --commit"):
        main.run(spark, main.parser().parse_args(["compact", "--root", root]))
