"""Near-duplicate groups by weighted MinHash of word shingles (BagMinHash), banding and exact checks.

A document is the multiset of its runs of ``SHINGLE`` words (ASCII letters in lower case, other ASCII characters but
digits and letters divide words); one with fewer words is a single run. Weights are numbers of occurrences, cut into
the dyadic strips (0,1], (1,2], (2,4], ... Every strip of every shingle has a Poisson process of its own, whose points
come in order of time from hashes of shingle, strip and number; a point has a level inside its strip and counts for weights
that reach it (so a strip is refined only where a weight ends inside), and falls on one of the signature's components.
A component keeps the time of its first point. Two documents agree in a component with a probability of exactly
their weighted Jaccard similarity, sum of least over sum of greatest weights. Processes are followed only as
long as they can still come first somewhere.

Documents with equal multisets are one node. Nodes that agree in a band share a bucket; there each is compared with
two pivots, the node that meets most others and one chosen by hash, which links most of a bucket at a cost in proportion to its
size. Nodes of one bucket that these links leave outside its commonest component are then compared with all
others of the bucket, block by block: nothing is lost to the shortcut. Every link is checked on the multisets; a group is a component of the links.

Nulls: a null text is empty; identifiers may be null and repeat. Documents without words are equal when their texts
are. Repeated rows each give a row with the same class. An empty table gives no rows. Extra columns are left out and
may have any names. Texts are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, staged, table
from sluicegate.llm.hashing import BASE, mix, word_hashes
from sluicegate.llm.links import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Nodes in a block, about.
BLOCK = 128
_SLICE = 1 << 20


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, occurrences) of each different shingle, by document, then hash."""
    word, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    whole = np.arange(len(word)) - first[owner] <= counts[owner] - SHINGLE
    short = (counts[owner] < SHINGLE) & (np.arange(len(word)) == first[owner])
    at = np.flatnonzero(whole | short)
    length = np.minimum(counts[owner[at]], SHINGLE)
    value = length.astype(np.uint64)
    for k in range(SHINGLE):
        there = k < length
        nxt = word[np.minimum(at + k, len(word) - 1)] if len(word) else word
        value = np.where(there, mix(value * BASE + nxt), value)
    order = np.lexsort((value, owner[at]))
    doc, value = owner[at][order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    place = np.flatnonzero(new)
    return doc[place], value[place], np.diff(np.append(place, len(doc)))


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int, size: int = BANDS * ROWS) -> np.ndarray:
    """Time of the first point in each component, infinite for documents without shingles."""
    strips = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    element = np.repeat(np.arange(len(doc)), strips)
    strip = np.arange(len(element)) - np.repeat(np.cumsum(strips) - strips, strips)
    owner, reach = doc[element], weight[element]
    low = np.where(strip == 0, 0, 2.0 ** (strip - 1))
    width = np.where(strip == 0, 1.0, low)
    seed = mix(value[element] + strip.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    total = np.bincount(doc, weight, docs)
    limit = (np.log(size) + 4) * size / np.maximum(total, 1)
    time, number = np.zeros(len(seed)), np.zeros(len(seed), np.uint64)
    flat = np.full(docs * size, np.inf)
    active = np.arange(len(seed))
    while len(active):
        count = np.ceil(np.clip((limit[owner[active]] - time[active]) * width[active], 0, 4000)).astype(np.int64) + 1
        count = np.where(count > 4, count, 1)  # one by one where few are left to come
        which = np.repeat(active, count)
        start = np.cumsum(count) - count
        step = np.arange(len(which)) - np.repeat(start, count)
        bits = mix(seed[which] + (number[which] + step.astype(np.uint64) + np.uint64(1)) * BASE)
        gap = -np.log1p(-((bits >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / width[which]
        # added one by one: equal points need equal times in every document, whatever else is at hand
        when = time[active] + gap if len(which) == len(active) else _added(time[active], gap, start, count)
        other = mix(bits + np.uint64(0xA0761D6478BD642F))
        level = low[which] + width[which] * ((other >> np.uint64(32)).astype(np.float64) * 2.0**-32)
        valid = np.flatnonzero((level < reach[which]) & (when <= limit[owner[which]]))
        component = ((other & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(flat, owner[which[valid]] * size + component[valid], when[valid])
        last = start + count - 1
        time[active], number[active] = when[last], number[active] + count.astype(np.uint64)
        most = flat.reshape(docs, size).max(axis=1) if docs else np.zeros(0)
        full = np.isfinite(most)
        limit = np.where(full, np.minimum(limit, most), limit)
        active = active[time[active] < limit[owner[active]]]
        if not len(active):  # documents with a component still empty go on
            lacking = ~full & (total > 0)
            if lacking.any():
                limit = np.where(lacking, limit * 2, limit)
                active = np.flatnonzero(lacking[owner] & (time < limit[owner]))
    return flat.reshape(docs, size)


def _added(base: np.ndarray, gap: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Running sums from ``base`` on, added one after the other in each run."""
    out = np.empty(len(gap))
    now = base.copy()
    for k in range(int(count.max())):
        going = np.flatnonzero(count > k)
        now[going] += gap[start[going] + k]
        out[start[going] + k] = now[going]
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One hash per band of a signature."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out * BASE + bits[:, :, k])
    return out.view(np.int64)


def _multiset(value: np.ndarray, weight: np.ndarray) -> bytes:
    """Sorted 32-bit hashes, each as often as it occurs."""
    return np.sort(np.repeat((value >> np.uint64(32)).astype("<u4"), weight)).tobytes()


def weighted_jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    ux, cx = np.unique(x, return_counts=True)
    uy, cy = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    both = int(np.minimum(cx[i], cy[j]).sum())
    return both / (len(x) + len(y) - both)


def _keys(texts: list[str | None], doc: np.ndarray, value: np.ndarray, weight: np.ndarray) -> list[bytes]:
    """A name for each multiset; of the text where there are no words."""
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for k, text in enumerate(texts):
        a, b = cuts[k], cuts[k + 1]
        body = b"s" + value[a:b].tobytes() + weight[a:b].tobytes() if b > a else b"t" + (text or "").encode("utf-8", "surrogatepass")
        out.append(hashlib.blake2b(body, digest_size=12).digest())
    return out


def sketch(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(_id, key, size, bands) per document; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", _SLICE):
            texts = batch.column("_text").to_pylist()
            doc, value, weight = shingles(texts)
            sizes = np.bincount(doc, weight, len(texts)).astype(np.int64)
            hashed = bands(signatures(doc, value, weight, len(texts)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(_keys(texts, doc, value, weight), pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([h if n else None for h, n in zip(hashed.tolist(), sizes.tolist())], pa.list_(pa.int64())),
                ],
                ["_id", "key", "size", "bands"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, key binary, size bigint, bands array<bigint>")


def multisets(docs: DataFrame, wanted: DataFrame, text: str, id_col: str) -> DataFrame:
    """(key, body) of the nodes in ``wanted`` (key, rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", _SLICE):
            texts = batch.column("_text").to_pylist()
            doc, value, weight = shingles(texts)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            bodies = [_multiset(value[a:b], weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(_keys(texts, doc, value, weight), pa.binary()), pa.array(bodies, pa.binary())], ["key", "body"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    own = rows.join(wanted.select(F.col("rep").alias("_id")).distinct(), "_id", "left_semi").select("_text")
    # no identifier leads to nodes without one: all rows without are read, each body once per task before it moves
    nameless = rows.filter("_id IS NULL").select("_text").mapInArrow(run, "key binary, body binary").dropDuplicates(["key"])
    # other texts under the same identifier, or without one, drop out by their key
    made = own.mapInArrow(run, "key binary, body binary").unionByName(nameless)
    return made.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


def verified(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            alike = pa.array([weighted_jaccard(p, q) >= similarity for p, q in zip(x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(alike), batch.column("b").filter(alike)], ["a", "b"])

    left = bodies.select(F.col("key").alias("a"), F.col("body").alias("x"))
    right = bodies.select(F.col("key").alias("b"), F.col("body").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """Per document: identifier, class (the smallest identifier in its group, null only if all are) and size of the class."""
    spark = docs.sparkSession
    sketched = staged(spark, sketch(docs, text, id_col), "near-sketch")
    nodes = staged(
        spark,
        sketched.groupBy("key").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.first("bands").alias("bands")),
        "near-nodes",
    )
    filed = nodes.select("key", "size", F.posexplode("bands").alias("band", "hash"))
    shared = filed.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(spark, filed.join(shared, ["band", "hash"]), "near-buckets")
    # who meets most others is most likely to be what they were copied from
    met = members.groupBy("key").agg(F.sum("n").alias("met"))
    pivots = (
        members.join(met, "key")
        .groupBy("band", "hash")
        .agg(F.max(F.struct("met", "key", "size")).alias("hub"), F.max(F.struct(F.xxhash64("key").alias("met"), "key", "size")).alias("other"))
    )
    close = lambda m, n: (m * similarity <= n) & (n * similarity <= m)  # noqa: E731  no pair beyond can be alike enough
    first = _pairs(
        members.join(pivots, ["band", "hash"])
        .select(F.col("key").alias("a"), "size", F.explode(F.array("hub", "other")).alias("p"))
        .filter(close(F.col("size"), F.col("p.size")))
        .select("a", F.col("p.key").alias("b"))
    )
    wanted = members.select("key").distinct().join(nodes.select("key", "rep"), "key")
    bodies = staged(spark, multisets(docs, wanted, text, id_col), "near-bodies")
    roots = components(verified(first, bodies, similarity))
    more = staged(spark, _between_blocks(members, roots, bodies, similarity), "near-more")
    if more.take(1):
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    groups = nodes.select("key", "rep", "n").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    classes = groups.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    named = groups.select("key", "root").join(classes, "root").select("key", "class_id", "class_size")
    return sketched.select("_id", "key").join(named, "key").select(F.col("_id").alias(id_col), "class_id", "class_size")


def _between_blocks(members: DataFrame, roots: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join different components inside a bucket.

    Nodes outside a bucket's commonest component meet all nodes of the bucket. Both are collected in blocks of about ``BLOCK``
    nodes, so a row stands for a pair of blocks, and a pair of blocks gives fewer links than it has nodes.
    """
    spark = members.sparkSession
    placed = members.select("band", "hash", "key", "n").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    kinds = placed.groupBy("band", "hash", "root").agg(F.count(F.lit(1)).alias("_own"))
    main = kinds.groupBy("band", "hash").agg(F.max(F.struct("_own", "root")).alias("_main"), F.count(F.lit(1)).alias("_kinds")).filter("_kinds > 1")
    mixed = placed.join(main.select("band", "hash", F.col("_main.root").alias("main")), ["band", "hash"]).join(bodies, "key")
    block = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / BLOCK)).alias("block")
    one = F.struct("key", "root", "body")
    apart = ["band", "hash"]
    whole = staged(spark, mixed.select(*apart, "root", "main", "key", "body", block), "near-mixed")
    left = whole.filter("root != main").groupBy(*apart, "block").agg(F.collect_list(one).alias("x")).drop("block")
    right = whole.groupBy(*apart, "block").agg(F.collect_list(one).alias("y")).drop("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = block_links(batch.column("x")[i].as_py(), batch.column("y")[i].as_py(), similarity)
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return left.join(right, apart).select("x", "y").mapInArrow(run, "a binary, b binary").distinct()


def block_links(x: list[dict], y: list[dict], similarity: float) -> list[tuple[bytes, bytes]]:
    """Links between nodes of two blocks, as many as it takes to join the components that they join."""
    rows = [np.frombuffer(d["body"], "<u4") for d in (*x, *y)]
    sizes = np.array([len(r) for r in rows])
    if not sizes.sum():
        return []
    value = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    place = np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))
    # the k-th occurrence of a shingle is an element of its own, so that common elements are least weights
    element = value.astype(np.uint64) << np.uint64(32) | (np.arange(len(value)) - place).astype(np.uint64)
    _, element = np.unique(element, return_inverse=True)
    both = np.zeros((len(x), len(y)), np.float32)
    at_x, at_y = np.flatnonzero(owner < len(x)), np.flatnonzero(owner >= len(x))
    for a in range(0, int(element.max()) + 1, 4096):
        p = at_x[(element[at_x] >= a) & (element[at_x] < a + 4096)]
        q = at_y[(element[at_y] >= a) & (element[at_y] < a + 4096)]
        if len(p) and len(q):
            left, right = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
            left[owner[p], element[p] - a] = 1
            right[owner[q] - len(x), element[q] - a] = 1
            both += left @ right.T
    union = sizes[: len(x), None] + sizes[None, len(x) :] - both
    parent: dict[bytes, bytes] = {}

    def top(node: bytes) -> bytes:
        while parent.setdefault(node, node) != node:
            node = parent[node]
        return node

    out = []
    alike = np.divide(both, union, out=np.zeros(both.shape), where=union > 0) >= similarity
    for i, j in zip(*np.nonzero(alike)):
        a, b = top(x[i]["root"]), top(y[j]["root"])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x[i]["key"], y[j]["key"]))
    return out


def _pairs(pairs: DataFrame) -> DataFrame:
    """Each pair once."""
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
