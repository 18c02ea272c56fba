"""Change-data ingestion into the lake, and de-duplication with a time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sluicegate.constants import DEDUP_KEY, DEDUP_TTL_MS
from sluicegate.operators.cdc import cdc_clean_rows, cdc_parse_clean
from sluicegate.operators.clean import dirty_records
from sluicegate.session import use_state_backend
from sluicegate.sinks.lake import append_changes, upsert_lake
from sluicegate.sinks.tables import write_dirty
from sluicegate.streaming.marks import query_id
from sluicegate.streaming.stages import start


def start_cdc_to_lake(
    envelopes: DataFrame,
    root: str,
    arrival: str | tuple[str, ...] = "arrival",
    trigger: str | None = "30 seconds",
    name: str = "cdc",
    rewrite: bool = False,
) -> StreamingQuery:
    """Clean change envelopes and bring each micro-batch into the lake as one commit.

    Changes are appended and resolved on read and in compaction; ``rewrite`` replaces the
    touched days at once instead. A batch that this stream has committed is not written again; commits are named by the
    checkpoint's identity, so a new checkpoint on an old root skips nothing.
    """
    order = (arrival,) if isinstance(arrival, str) else arrival
    apply = upsert_lake if rewrite else append_changes

    def each_batch(tagged: DataFrame, batch_id: int) -> None:
        spark = tagged.sparkSession
        tagged = tagged.persist()
        try:
            write_dirty(dirty_records(tagged), f"{root}/dirty", batch_id)
            owner = query_id(spark, f"{root}/checkpoints/{name}")
            apply(spark, root, cdc_clean_rows(tagged, order), "-".join(filter(None, (name, owner, str(batch_id)))), arrival)
        finally:
            tagged.unpersist()

    tagged = cdc_parse_clean(envelopes, key_moves=True)
    return start(tagged, f"{root}/checkpoints/{name}", each_batch, trigger, name)


class _FirstSeen(StatefulProcessor):
    """Remembers a key for a while after a row of it was passed on."""

    def __init__(self, arrival: str, ttl_ms: int):
        self._arrival, self._ttl_ms = arrival, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean", ttlDurationMs=self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            lowest = batch.nsmallest(1, self._arrival)
            if first is None or lowest[self._arrival].iloc[0] < first[self._arrival].iloc[0]:
                first = lowest
        if first is not None and not self._seen.exists():
            self._seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def dedup_ttl_stream(changes: DataFrame, arrival: str = "arrival", ttl_ms: int = DEDUP_TTL_MS) -> DataFrame:
    """Pass on the first row of a key, then none for ``ttl_ms`` of processing time.

    The stream never ends by itself, not even with an available-now trigger: stop it.
    """
    use_state_backend(changes.sparkSession)
    return changes.groupBy(*DEDUP_KEY).transformWithStateInPandas(
        _FirstSeen(arrival, ttl_ms), changes.schema, outputMode="Append", timeMode="ProcessingTime"
    )
