"""Entry points for spark-submit: ``main.py logs|changes|plain|compact --root .. [--topic .. --servers ..]``.

The streams read a Kafka topic; ``compact`` rewrites the lake's small files, of one day where ``--dt`` is given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sluicegate.constants import MIN_INPUT_FILES
from sluicegate.plans import upkeep
from sluicegate.session import build_session
from sluicegate.sources.logs import read_cdc_envelopes, read_raw_logs
from sluicegate.streaming import changes, stages

#: With several partitions in a topic, time, partition and offset together order arrivals.
ORDER = ("arrived_at", "partition", "arrival")
KINDS = {"arrived_at": "timestamp", "partition": "int", "arrival": "bigint"}


def parser() -> argparse.ArgumentParser:
    found = argparse.ArgumentParser(description=__doc__)
    found.add_argument("job", choices=("logs", "plain", "changes", "compact"))
    found.add_argument("--root", required=True, help="folder of the tables")
    found.add_argument("--topic")
    found.add_argument("--servers", help="Kafka bootstrap servers")
    found.add_argument("--offsets", default="latest")
    found.add_argument("--trigger", default="30 seconds")
    found.add_argument("--commit", help="name of the compaction's commit")
    found.add_argument("--dt", help="day to compact")
    found.add_argument("--min-input-files", type=int, default=MIN_INPUT_FILES)
    return found


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "compact":
        if not args.commit:
            raise SystemExit("compact needs --commit")
        upkeep.compact_partitions(spark, args.root, args.commit, dt=args.dt, min_input_files=args.min_input_files).show()
        return
    if not (args.topic and args.servers):
        raise SystemExit(f"{args.job} needs --topic and --servers")
    if args.job == "changes":
        envelopes = read_cdc_envelopes(spark, args.topic, args.servers, args.offsets)
        changes.start_cdc_to_lake(envelopes, args.root, ORDER, args.trigger)
    else:
        logs = read_raw_logs(spark, args.topic, args.servers, args.offsets)
        if args.job == "plain":
            stages.start_plain_ingestion(logs, args.root, trigger=args.trigger)
        else:
            stages.start_cleaning(logs, args.root, arrival=ORDER, trigger=args.trigger)
            stages.start_dedup(spark, args.root, arrival=KINDS, trigger=args.trigger)
    spark.streams.awaitAnyTermination()


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    run(build_session(f"sluicegate-{args.job}"), args)


if __name__ == "__main__":
    main()
