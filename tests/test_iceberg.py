"""Statements for an Iceberg catalog: Spark's parser takes them. None is run, as the connector is not here.

What the merge does is checked as a join with the same conditions.
"""

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY
from sluicegate.schema import LAKE, LAKE_COLUMNS
from sluicegate.sinks import iceberg

STATEMENTS = {
    "create": iceberg.create_statement("lake.ods.actions", "user_id STRING, dt DATE"),
    "merge": iceberg.merge_statement("lake.ods.actions", "changes"),
    "rewrite": iceberg.rewrite_statement("lake", "ods.actions"),
    "rewrite_days": iceberg.rewrite_statement("lake", "ods.actions", "dt = '2025-11-11'", 3),
    "purge": iceberg.purge_statement("lake.ods.actions", "2025-11-11 00:00:00"),
    "expire": iceberg.expire_statement("lake", "ods.actions", "2025-11-11 00:00:00"),
    "orphans": iceberg.orphans_statement("lake", "ods.actions", "2025-11-11 00:00:00"),
}


@pytest.mark.parametrize("name", STATEMENTS)
def test_statement_parses(spark, name):
    assert spark._jsparkSession.sessionState().sqlParser().parsePlan(STATEMENTS[name]) is not None


def test_merge_speaks_of_every_column_and_key():
    text = STATEMENTS["merge"]
    assert all(f"t.{name} = s.{name}" in text for name in LAKE_COLUMNS)
    assert all(f"t.{name} <=> s.{name}" in text for name in ("dt", *DEDUP_KEY))
    assert "dry_run => true" in STATEMENTS["orphans"] and "''2025-11-11''" in STATEMENTS["rewrite_days"]


def merged(target, source):
    """The merge as a join: its conditions are taken from the statement, its two clauses are carried out by hand."""
    text = STATEMENTS["merge"]
    on, newer = re.search(r" ON (.*?) WHEN MATCHED AND (.*?) THEN UPDATE SET .* WHEN NOT MATCHED THEN INSERT", text).groups()
    both = target.withColumn("_t", F.lit(1)).alias("t").join(source.withColumn("_s", F.lit(1)).alias("s"), F.expr(on), "full")
    takes = F.expr(f"t._t IS NULL OR (s._s IS NOT NULL AND {newer})")
    return both.select(*(F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in LAKE_COLUMNS))


def test_a_delete_outlives_a_delayed_update(spark):
    """Whatever order the batches come in, the newest change of each key decides."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAKE.fields)
    start = dt.datetime(2025, 11, 11, tzinfo=dt.timezone.utc)

    def batch(*changes):
        rows = []
        for user, op, second, page in changes:
            values = {"user_id": user, "event_type": "view", "event_time": start, "dt": start.date(), "op_type": op, "page": page,
                      "op_ts": start + dt.timedelta(seconds=second)}
            rows.append(tuple(values.get(name) for name in LAKE.fieldNames()))
        return spark.createDataFrame(rows, schema).select(*LAKE_COLUMNS)

    batches = [
        batch(("a", "I", 0, "1"), ("b", "I", 0, "1"), ("d", "D", 7, None)),
        batch(("a", "D", 5, None), ("b", "U", 5, "2"), ("d", "U", 6, "old")),
        batch(("a", "U", 3, "late"), ("c", "U", 1, "3"), ("b", "U", 4, "late")),
    ]
    for order in itertools.permutations(batches):
        table = spark.createDataFrame([], schema).select(*LAKE_COLUMNS)
        for part in order:
            table = merged(table, part)
        live = table.where("op_type IS NULL OR op_type <> 'D'")
        assert sorted((r["user_id"], r["page"]) for r in live.collect()) == [("b", "2"), ("c", "3")]
