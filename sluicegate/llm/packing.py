"""Mixture-controlled packing of token ids into windows of fixed length.

Every source is a queue of its documents' ids. Deficit round-robin goes over the queues in a
fixed order: for each window a queue is owed its share of the window, takes the whole tokens out of
what it and the queues before it are owed so far, and the fraction that is left, the deficit, stays for
the next window. After ``k`` windows of a phase the first ``s`` queues together have thus taken
``floor(k * total_s / windows)`` tokens, where ``total_s`` is what they take in the whole phase, and no
queue is ever a whole token away from its share. Since this is known for every ``k``, any
partition can start at any window with the deficits carried up to there, and no ids are shuffled.

Without ``weights`` the shares are those of the corpus and all queues end together. With them, a phase
lasts until some queue can no longer fill its share of a window; its rest goes into one window and the
others share on. Windows are full but for the last one.

Sources that own less than a token per window are joined to one queue (so there are no more than ``length`` others).
There, documents follow one another by their relative place in their own source, counted up to a point inside the
document that a hash of the source picks; so each source stays at its share all along, as nearly as whole documents
allow. Ids of these documents alone are shuffled. Within another queue, documents follow one another
in the order of the tasks that encoded them. Nulls: a null text is empty (its end id is packed); a null
source is a queue of its own. Repeated rows and equal identifiers are packed each. An empty table
gives no pieces. Extra columns are left out and may have any names. Long documents are cut.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, staged, table, with_start
from sluicegate.llm.tokenize import binary, encoder, narrow

LENGTH = 4096
#: Rows that a task returns at once, at most.
PIECES = 1 << 16


@dataclass(frozen=True)
class Phase:
    """``windows`` windows from ``first`` on, over which the queues up to and with ``s`` take ``takes[s]`` tokens in all, having taken ``done[s]`` each before."""

    first: int
    windows: int
    takes: array[int]  # cumulative over queues
    done: array[int]  # of each queue before this phase

    def upto(self, queue: int, k: int) -> int:
        """Tokens of all queues up to and with ``queue`` in the first ``k`` windows."""
        return k * self.takes[queue] // self.windows if queue >= 0 else 0

    def taken(self, queue: int, k: int) -> int:
        return self.upto(queue, k) - self.upto(queue - 1, k)


def _rounded(shares: list[float], total: int, most: list[int]) -> list[int]:
    """Whole numbers near ``shares`` with the given sum, none above ``most``."""
    out = [min(int(x), m) for x, m in zip(shares, most)]
    order = sorted(range(len(out)), key=lambda s: out[s] - shares[s])
    while (rest := total - sum(out)) > 0:
        room = [s for s in order if out[s] < most[s]]
        for s in room[:rest]:
            out[s] += min(most[s] - out[s], max(1, rest // len(room)))
        if sum(out) > total:
            raise AssertionError("shares above the total")
    return out


def phases(totals: list[int], weights: list[float] | None, length: int) -> list[Phase]:
    """How many tokens each queue gives to each run of windows, until all queues are empty."""
    left, done, out, window = list(totals), [0] * len(totals), [], 0
    while any(left):
        owed = [(weights[s] if weights else left[s]) if left[s] else 0 for s in range(len(left))]
        unit = sum(owed)
        everything = sum(left)
        if everything <= length:
            count, take = 1, list(left)
        else:
            count = min((left[s] * unit // (length * owed[s]) for s in range(len(left)) if owed[s]), default=0)
            count = int(min(count, everything // length))
            if count:
                take = _rounded([count * length * o / unit for o in owed], count * length, left)
            else:  # some queue has less than its share of one window: it ends here
                count, take = 1, _rounded([min(length * o / unit, n) for o, n in zip(owed, left)], length, left)
        out.append(Phase(window, count, array("q", accumulate(take)), array("q", done)))
        window += count
        left = [n - t for n, t in zip(left, take)]
        done = [n + t for n, t in zip(done, take)]
    return out


def queues_of(totals: dict[str | None, int], weights: dict[str | None, float] | None, length: int) -> dict[str | None, int]:
    """The queue of each source: the smallest sources share the last one until each queue owns a token per window."""
    owned = weights or totals
    order = sorted(totals, key=lambda s: (-owned.get(s, 0), s is not None, s or ""))
    whole = sum(owned.get(s, 0) for s in order) or 1
    alone, rest = list(order), []
    while len(alone) > 1 and (owned.get(alone[-1], 0) * length < whole or rest and sum(owned.get(s, 0) for s in rest) * length < whole):
        rest.append(alone.pop())
    return {s: i for i, s in enumerate(alone)} | {s: len(alone) for s in rest}


def cut(plan: list[Phase], queue: int, start: int, size: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(start in the document, length, window, offset there) for tokens ``start .. start + size`` of a queue."""
    at = 0
    for phase in plan:
        total = phase.taken(queue, phase.windows)
        inside = start + at - phase.done[queue]
        if inside >= total or at >= size:
            continue
        k = max(0, min(phase.windows - 1, inside * phase.windows // total - 1))
        while phase.taken(queue, k + 1) <= inside:
            k += 1
        while at < size and inside < total:
            begin, end = phase.taken(queue, k), phase.taken(queue, k + 1)
            if end > inside:
                n = min(end - inside, size - at)
                before = phase.upto(queue - 1, k + 1) - phase.upto(queue - 1, k)
                yield at, n, phase.first + k, before + inside - begin
                at += n
                inside += n
            k += 1
            # the same window goes on in the next document
    if at != size:
        raise AssertionError("tokens beyond the plan")


def interleaved(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(_s, _p, _i, _start): the place in a common queue of each document of some sources, by relative place in its source."""
    sums = parts.groupBy("_source").agg(F.sum("_n").alias("_total")).select(F.col("_source").alias("_s"), "_total")
    docs = parts.agg(F.sum("_docs")).first()[0]
    # a point inside the document, so that sources of one document do not all come first
    point = F.pmod(F.xxhash64("_source"), F.lit(1 << 20)) / F.lit(1 << 20)
    order = F.floor((F.col("_start") + point * F.col("_size")) / F.col("_total") * docs)
    placed = rows.join(sums, F.col("_source").eqNullSafe(F.col("_s"))).select("_s", F.col("_part").alias("_p"), F.col("_inside").alias("_i"), "_size", order.alias("_order"))
    return with_start(placed, [], "_order", "_size", "_at").select("_s", "_p", "_i", F.col("_at").alias("_start"))


def pack(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    length: int = LENGTH,
    weights: dict[str | None, float] | None = None,
    tokenizer: str = "word_bpe_49k.json",
    tokenizers: str | None = None,
    special_as_text: bool = False,
) -> DataFrame:
    """Pieces of documents: where each lies in its document, its ids and their checksum, its window and place there.

    ``weights`` gives the wanted share of each source; by default that of its tokens. With
    weights, every source needs one of at least ``1 / length`` of their sum.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, used = encoder(tokenizer, tokenizers, special_as_text), TaskContext.get().partitionId(), {}
        for batch in slices(batches, "_text"):
            ids, ends = coder.encode_column(batch.column("_text"))
            sizes, starts = np.diff(ends, prepend=0), []
            for queue, size in zip(batch.column("_source").to_pylist(), sizes.tolist()):
                starts.append(used.get(queue, 0))
                used[queue] = starts[-1] + size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_source"),
                    pa.array([part] * batch.num_rows, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    binary(narrow(ids, coder.vocabulary), ends),
                ],
                ["_id", "_source", "_part", "_inside", "_size", "tokens"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(source).cast("string").alias("_source"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    encoded = staged(
        spark, rows.mapInArrow(encode, f"_id {kind}, _source string, _part bigint, _inside bigint, _size bigint, tokens binary"), "packed-ids"
    )
    own = encoded.groupBy("_source", "_part").agg(F.sum("_size").alias("_n"), F.count(F.lit(1)).alias("_docs"))
    parts = with_start(own, ["_source"], "_part", "_n", "_before")
    parts = staged(spark, parts, "packed-parts")
    totals = {r["_source"]: int(r["n"]) for r in parts.groupBy("_source").agg(F.sum("_n").alias("n")).collect()}  # one row per source
    if weights is not None:
        missing = [s for s in totals if weights.get(s, 0) * length < sum(weights.values())]
        if missing:
            raise ValueError(f"sources without a weight of a token per window: {missing[:5]}")
    queue_of = queues_of(totals, weights, length)
    sizes = [0] * (max(queue_of.values(), default=-1) + 1)
    for s, k in queue_of.items():
        sizes[k] += totals[s]
    shares = None
    if weights is not None:
        shares = [0.0] * len(sizes)
        for s in totals:
            shares[queue_of[s]] += weights[s]
    plan = phases(sizes, shares, length)

    def pieces(batch: pa.RecordBatch, out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column("_id").take(pa.array(out[0], pa.int64())),
                *(pa.array(c, pa.int64()) for c in out[1:7]),
                pa.array(out[7], pa.binary()),
            ],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tokens"):
            out: list[list] = [[] for _ in range(8)]
            rows = zip(*(batch.column(c).to_pylist() for c in ("_source", "_start", "_size", "tokens")))
            for i, (name, start, size, raw) in enumerate(rows):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                for at, n, window, offset in cut(plan, queue_of[name], start, size, length):
                    piece = ids[at : at + n].tobytes()
                    for column, value in zip(out, (i, at, n, zlib.crc32(piece), size, window, offset, piece)):
                        column.append(value)
                    if len(out[0]) >= PIECES:
                        yield pieces(batch, out)
                        out = [[] for _ in range(8)]
            yield pieces(batch, out)

    # sources that share a queue, by name
    counts = Counter(queue_of.values())
    joined = [(s, True) for s in totals if counts[queue_of[s]] > 1]
    if joined:
        names = spark.createDataFrame(joined, "_few string, _shared boolean")
        parts = parts.join(names, F.col("_source").eqNullSafe(F.col("_few")), "left").withColumn("_shared", F.coalesce("_shared", F.lit(False)))
    else:
        parts = parts.withColumn("_shared", F.lit(False))
    placed = encoded.join(
        parts.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), "_before", "_shared"),
        F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")),
    ).select("_id", "_source", "_part", "_inside", (F.col("_before") + F.col("_inside")).alias("_start"), "_size", "tokens", "_shared")
    wanted = ["_id", "_source", "_start", "_size", "tokens"]
    if joined:
        few = placed.filter("_shared")
        starts = staged(spark, interleaved(few, parts.filter("_shared")), "packed-few")
        same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")) & (F.col("_inside") == F.col("_i"))
        placed = placed.filter("NOT _shared").select(*wanted).unionByName(few.drop("_start").join(starts, same).select(*wanted))
    placed = placed.select(*wanted)
    return placed.mapInArrow(
        deal,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
