"""Timings of the headline queries; prints one JSON line.

Each query runs over the whole ``events`` table of ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``: once to warm up, then several times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import fixtures
from sluicegate.checks.queries import queries
from sluicegate.operators import cdc, clean
from sluicegate.session import build_session, work_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "hourly_event_count",
    "clean_events",
    "dirty_rate",
    "collect_ext_json",
    "cdc_parse_clean",
    "cdc_latest_state",
    "route_late",
    "route_late_batches",
    "dedup_first_seen",
    "dedup_ttl",
    "late_rate",
    "late_histogram",
    "late_backfill",
    "quality_monitor",
    "partition_distribution",
    "write_lake",
)
#: Whole pipelines with many small jobs; timed once.
PIPELINES = ("upsert_lake", "append_changes", "compact_partitions", "stream_late_dedup", "stream_cdc_to_lake")


def timed(run: Callable[[], object]) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def to_nowhere(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(build: Callable[[], DataFrame]) -> float:
    to_nowhere(build())
    return round(statistics.median(timed(lambda: to_nowhere(build())) for _ in range(RUNS)), 3)


def rows_per_second(spark: SparkSession, sf_dir: str, copies: int = 10) -> dict[str, int]:
    """Parse-and-clean speed over stored raw text, the table replicated so that start-up does not count."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    speeds = {}
    for name, raw, tag in (
        ("clean_events", fixtures.raw_logs(events), lambda df: clean.clean_events(df, fixtures.AS_OF)),
        ("cdc_parse_clean", fixtures.cdc_envelopes(events), cdc.cdc_parse_clean),
    ):
        path = work_dir(spark, "bench")
        raw.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select("raw").repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        stored = spark.read.parquet(path)
        rows = stored.count()
        speeds[name] = round(rows / median_time(lambda stored=stored, tag=tag: tag(stored)))
    return speeds


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS),
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in HEADLINE:
        seconds[name] = median_time(lambda name=name: registered[name](spark, SF_DIR))
        print(name, seconds[name], file=sys.stderr, flush=True)
    for name in PIPELINES:
        seconds[name] = round(timed(lambda name=name: to_nowhere(registered[name](spark, SF_DIR))), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    speeds = rows_per_second(spark, SF_DIR)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "rows_per_second": speeds,
        "cores": int(CPUS),
        "spark": spark.version,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
