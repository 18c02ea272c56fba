"""Running streams: restarts from the checkpoint and live counters."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def run_with_restarts(start_query: Callable[[], StreamingQuery], restarts: int = 3, pause_seconds: float = 5.0) -> None:
    """Wait for the query; when it fails start it again from its checkpoint, a bounded number of times."""
    for attempt in range(restarts + 1):
        try:
            start_query().awaitTermination()
            return
        except Exception:
            if attempt == restarts:
                raise
            time.sleep(pause_seconds)


def observe_quality(tagged: DataFrame, name: str = "quality") -> DataFrame:
    """Attach counters to a stream; a query listener finds them in every progress report."""
    return tagged.observe(
        name,
        F.count(F.lit(1)).alias("raw_cnt"),
        F.count_if(F.col("verdict") == "CLEAN").alias("cleaned_cnt"),
        F.count_if(F.col("verdict") == "DIRTY").alias("dirty_cnt"),
        F.max("event_time").alias("newest_event_time"),
    )
