"""Exact Jaccard self-join of shingle sets by a token-group matrix.

A document is the set of its runs of ``SHINGLE`` words (words end at ASCII white space, A-Z count as a-z). Documents with equal sets
are one node. Nodes that agree in half of their min-hashes with the hub of a bucket form its group; all others are groups of their own.

All tokens have one order: those that are rare come before those that are common, then by hash. Of sets x and y with at least
a tokens in common, the first |x| - a + l and |y| - a + l tokens share l. So the matrix holds, for each group, the union of its
members' first tokens, l being one more than a 32nd of a set: a query meets a group only if at least l of its own first tokens
are in that union, which bounds what it can share with any member. Tokens that only one node has never reach the matrix.

A group that qualifies is opened from its centre. Members alike enough to the centre are its core, linked already: a query linked to
the centre needs none of them. Distances 1 - J obey the triangle inequality, so members whose distance to the centre differs by
more than 0.15 from the query's cannot be linked. What is left meets the query on first tokens, each with its place, which bounds
the tokens still in common; then whole sets are compared. Components of all links are the classes. Nothing is estimated: min-hashes and
the list of common tokens only decide who is compared first.

Common tokens are those that chunks of documents repeat, more than ``COMMON`` times or a 2^20th of all such repeats in all; at most 2^20
tokens, which are broadcast as a bitmap of 2^24 bits. A bitmap as large tells tasks which documents' whole sets are wanted. False
positives change the order or add work, no result. Sets are told apart by 64-bit hashes of tokens.

Nulls: a null text has no words and is linked with nothing, as is an empty one. Identifiers may be null and repeat; every row
is in the class of its set, whose name is the smallest identifier in it (null only if all are). Repeated rows give a row each. An
empty table gives no rows. Extra columns are left out and may have any names. Texts are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, staged, table
from sluicegate.llm.hashing import BASE, mix, word_hashes
from sluicegate.llm.links import components

SHINGLE = 4
#: A link: this many hundredths of the union are common.
SIMILARITY = 85
MIN_HASHES = 8
COMMON = 16
#: Tokens that two linked sets share, at least, by the sum of their sizes.
_LEAST = f"({SIMILARITY} * ({{}}) + {99 + SIMILARITY}) div {100 + SIMILARITY}"
#: Tokens that a task counts at once.
CHUNK = 2 << 20
_BITS = 1 << 24
_SLICE = 1 << 20
_FOLD = np.array([c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256)], np.uint8)
_SEEDS = [np.uint64(mix(np.array([k + 1], np.uint64) * BASE)[0]) for k in range(MIN_HASHES)]


def token_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of each different shingle, by document, then token."""
    word, owner = word_hashes(texts, _FOLD)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    place = np.arange(len(word)) - first[owner]
    at = np.flatnonzero((place <= counts[owner] - SHINGLE) | ((counts[owner] < SHINGLE) & (place == 0)))
    length = np.minimum(counts[owner[at]], SHINGLE)
    value = length.astype(np.uint64)
    for k in range(SHINGLE):
        nxt = word[np.minimum(at + k, len(word) - 1)] if len(word) else word
        value = np.where(k < length, mix(value * BASE + nxt), value)
    order = np.lexsort((value, owner[at]))
    doc, value = owner[at][order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def extra(size):
    """How many tokens more than one the first tokens of two linked sets share, at least; grows with the size."""
    return size // 32


def least_common(size):
    """Tokens that a set of this size shares with any set linked to it, at least."""
    return -(-SIMILARITY * size // 100)


def _keys(cuts: np.ndarray, value: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(cuts[:-1], cuts[1:])]


def _cuts(doc: np.ndarray, docs: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(docs + 1))


def _in(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the bits of numbers are set."""
    low = value & np.uint64(_BITS - 1)
    return bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1) == 1


def bitmap(numbers: DataFrame) -> np.ndarray:
    """2^24 bits, set for the low bits of the only column."""
    low = F.col(numbers.columns[0]).bitwiseAND(F.lit(_BITS - 1).cast("bigint"))
    word, bit = F.shiftright(low, 6).cast("int"), F.expr(f"shiftleft(1L, cast({numbers.columns[0]} & 63 AS int))")
    out = np.zeros(_BITS // 64, np.int64)
    for r in numbers.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[r.w] = r.b
    return out.view(np.uint64)


def _texts(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))


def common_tokens(docs: DataFrame) -> np.ndarray:
    """Bitmap of tokens that many sets have; ``docs`` has ``_text``."""

    def counted(values: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *values]), return_counts=True)
        many = n > 1
        return pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, size, seen = [], 0, set()
        for batch in slices(batches, "_text", _SLICE):
            texts = batch.column("_text").to_pylist()
            doc, value = token_sets(texts)
            keys = _keys(_cuts(doc, len(texts)), value)
            fresh = np.array([k not in seen and not seen.add(k) for k in keys], bool)  # equal sets of a chunk count once
            values.append(value[fresh[doc]])
            size += len(values[-1])
            if size >= CHUNK:
                yield counted(values)
                values, size, seen = [], 0, set()
        yield counted(values)

    counts = docs.select("_text").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    many = staged(docs.sparkSession, counts.filter(F.col("n") > COMMON), "groups-common")
    total = many.agg(F.sum("n").alias("n")).first()["n"] or 0
    return bitmap(many.filter(F.col("n") > total >> 20).select("token"))


def _lists(value: np.ndarray, keep: np.ndarray, doc: np.ndarray, docs: int) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[keep], minlength=docs)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[keep].view(np.int64)))


def sketched(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(key, _id, size, mins, firsts) of every document that has words: name of its set, min-hashes, first tokens in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", _SLICE):
            texts = batch.column("_text").to_pylist()
            doc, value = token_sets(texts)
            cuts = _cuts(doc, len(texts))
            sizes = np.diff(cuts)
            full = np.flatnonzero(sizes)
            mins = [np.minimum.reduceat(mix(value ^ seed), cuts[:-1][full]) if len(full) else np.zeros(0, np.uint64) for seed in _SEEDS]
            order = np.lexsort((_in(common, value), doc))
            place = np.arange(len(doc)) - cuts[doc]
            head = place < (sizes - least_common(sizes) + 1 + extra(sizes))[doc]
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(_keys(cuts, value), pa.binary()),
                    batch.column("_id"),
                    pa.array(sizes, pa.int64()),
                    _lists(value[order], head, doc, len(texts)),
                ],
                ["key", "_id", "size", "firsts"],
            ).take(pa.array(full))
            hashes = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(mins, axis=1).ravel().view(np.int64)), MIN_HASHES).cast(pa.list_(pa.int64()))
            yield made.append_column("mins", hashes)

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"key binary, _id {kind}, size bigint, firsts array<bigint>, mins array<bigint>")


def named(docs: DataFrame) -> DataFrame:
    """(_id, key, size) of every document; a null key without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", _SLICE):
            texts = batch.column("_text").to_pylist()
            doc, value = token_sets(texts)
            cuts = _cuts(doc, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(_keys(cuts, value), pa.binary()), pa.array(np.diff(cuts), pa.int64())], ["_id", "key", "size"])

    return docs.mapInArrow(run, f"_id {docs.schema['_id'].dataType.simpleString()}, key binary, size bigint")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, body) for the nodes in ``wanted`` (node, key, rep): all tokens, sorted, as bytes."""
    bits = bitmap(wanted.select(F.xxhash64("rep").alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            hit = _in(bits, whole.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
            for batch in slices([whole.filter(pa.array(hit))], "_text", _SLICE):
                texts = batch.column("_text").to_pylist()
                doc, value = token_sets(texts)
                cuts = _cuts(doc, len(texts))
                bodies = [value[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(_keys(cuts, value), pa.binary()), pa.array(bodies, pa.binary())], ["key", "body"])

    made = docs.select(F.xxhash64("_id").alias("h"), "_text").mapInArrow(run, "key binary, body binary").filter("key IS NOT NULL")
    return made.join(wanted.select("key", "node"), "key").groupBy("key").agg(F.first("node").alias("node"), F.first("body").alias("body")).drop("key")


def in_common(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the number of tokens that both nodes have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [
                len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                for x, y in zip(batch.column("x"), batch.column("y"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64())], ["a", "b", "both"])

    left = bodies.select(F.col("node").alias("a"), F.col("body").alias("x"))
    right = bodies.select(F.col("node").alias("b"), F.col("body").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, both bigint")


def linked(both: Column, m: Column, n: Column) -> Column:
    return both * 100 >= (m + n - both) * SIMILARITY


def comparable(m: Column, n: Column) -> Column:
    """Sizes of sets that can be linked."""
    return (m * 100 >= n * SIMILARITY) & (n * 100 >= m * SIMILARITY)


def grouped(nodes: DataFrame) -> DataFrame:
    """(node, hub): the hub that a node shares most min-hashes with, at least half of them, or the node itself."""
    filed = nodes.select("node", "size", F.posexplode("mins").alias("r", "v"))
    shared = filed.groupBy("r", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spark = nodes.sparkSession
    members = staged(spark, filed.join(staged(spark, shared, "groups-shared"), ["r", "v"]), "groups-buckets")
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = members.join(met, "node").groupBy("r", "v").agg(F.max(F.struct("met", "node", "size")).alias("hub"))
    votes = (
        members.join(staged(spark, hubs, "groups-bucket-hubs"), ["r", "v"])
        .filter((F.col("node") != F.col("hub.node")) & comparable(F.col("size"), F.col("hub.size")))
        .groupBy("node", "hub")
        .agg(F.count(F.lit(1)).alias("votes"))
        .filter(F.col("votes") * 2 >= MIN_HASHES)
    )
    best = votes.groupBy("node").agg(F.max(F.struct("votes", "hub")).alias("best")).select("node", F.col("best.hub.node").alias("hub"))
    several = best.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")  # a single follower stays by itself
    return nodes.select("node").join(best.join(several, "hub", "left_semi"), "node", "left").withColumn("hub", F.coalesce("hub", "node"))


def shared_tokens(nodes: DataFrame, common: np.ndarray) -> DataFrame:
    """(token, node, place): first tokens that more than one node has among its own.

    A common token is shared anyway; others have few rows each, so they can be counted where they meet.
    """
    bits = common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("firsts")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = lists.flatten()
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            often = _in(bits, tokens.to_numpy(zero_copy_only=False).view(np.uint64))
            node = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), sizes)))
            yield pa.RecordBatch.from_arrays([tokens, node, pa.array(place.astype(np.int32)), pa.array(often)], ["token", "node", "place", "often"])

    rows = nodes.select("node", "firsts").mapInArrow(run, "token bigint, node bigint, place int, often boolean")
    rare = rows.filter("NOT often").drop("often")
    met = rare.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("n > 1").drop("n")
    return met.unionByName(rows.filter("often").drop("often"))


def group_join(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: identifier, size of its set, smallest identifier that links lead to."""
    spark = docs.sparkSession
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: staged(spark, df, f"groups-{name}")
    rows = _texts(docs, text, id_col)
    common = common_tokens(rows)
    sets = sketched(rows, common).groupBy("key").agg(F.min("_id").alias("rep"), *(F.first(c).alias(c) for c in ("size", "firsts", "mins")))
    nodes = keep(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")
    hubs = grouped(nodes)
    sized = keep(hubs.join(hubs.groupBy("hub").agg(F.count(F.lit(1)).alias("members")), "hub").join(nodes.select("node", "key", "rep", "size"), "node"), "hubs")
    tokens = keep(shared_tokens(nodes, common).join(sized.select("node", "hub", "members", "size"), "node"), "tokens")

    # the matrix, and which groups a query can be linked into; of two groups the one with fewer members asks
    matrix = tokens.groupBy("token", F.col("hub").alias("group")).agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.first("members").alias("others")
    )
    asks = F.struct("members", "hub") < F.struct(F.col("others").alias("members"), F.col("group").alias("hub"))
    fits = (F.col("most") * 100 >= F.col("size") * SIMILARITY) & (F.col("size") * 100 >= F.col("least") * SIMILARITY)
    need = 1 + F.expr(f"(({SIMILARITY} * size + 99) div 100) div 32")
    queries = (
        tokens.join(matrix, "token")
        .filter((F.col("hub") != F.col("group")) & asks & fits)
        .groupBy("node", "group", "size", "others")
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("hits") >= need)
    )
    queries = keep(queries.select("node", "group", "others"), "queries")

    # the centre of a group is the member that meets most others early in the order of tokens
    early = tokens.filter((F.col("members") > 1) & (F.col("size") - F.col("place") >= F.expr(_LEAST.format("size + size")))).select("token", "hub", "node")
    met = early.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("met"))
    score = early.join(keep(met, "met"), ["hub", "token"]).groupBy("hub", "node").agg(F.sum("met").alias("met"))
    centres = keep(score.groupBy("hub").agg(F.max(F.struct("met", "node")).alias("best")).select("hub", F.col("best.node").alias("centre")), "centres")
    several = sized.filter("members > 1").join(centres, "hub", "left").select("node", "hub", F.coalesce("centre", "hub").alias("centre"))
    asking = queries.join(centres.withColumnRenamed("hub", "group"), "group", "left").select("node", "group", "others", F.coalesce("centre", "group").alias("centre"))

    # whole sets of everything that may be compared
    compared = several.select("node").union(several.select("centre")).union(asking.select("node")).union(asking.select("centre"))
    wanted = sized.join(compared.distinct(), "node", "left_semi").select("node", "key", "rep")
    bodies = keep(whole_sets(rows, wanted), "sets")

    # from members and queries to centres
    to_centre = several.filter("node != centre").select("node", "centre").union(asking.select("node", "centre")).distinct().toDF("a", "b")
    size_of = lambda name, as_: sized.select(F.col("node").alias(name), F.col("size").alias(as_))
    measured = keep(
        in_common(to_centre, bodies).join(size_of("a", "m"), "a").join(size_of("b", "n"), "b").withColumn("link", linked(F.col("both"), F.col("m"), F.col("n"))),
        "measured",
    )
    links = measured.filter("link").select("a", "b")

    # open groups: to queries of others, and to members that the centre is not linked to
    apart = (1 - F.col("both") / (F.col("m") + F.col("n") - F.col("both"))).alias("apart")
    distance = measured.select(F.col("a").alias("node"), F.col("b").alias("centre"), F.col("link").alias("core"), apart)
    inside = several.join(distance, ["node", "centre"], "left").select(
        "node", "hub", F.coalesce("core", F.lit(True)).alias("core"), F.coalesce("apart", F.lit(0.0)).alias("apart")
    )
    loose = inside.filter("NOT core").groupBy("hub").agg(F.count(F.lit(1)).alias("loose"))
    opened = (
        asking.filter("others > 1")
        .join(distance, ["node", "centre"])
        .select("node", F.col("group").alias("hub"), "core", "apart")
        .unionByName(inside.filter("NOT core"))
        .join(loose, "hub", "left")
        .filter("NOT core OR loose IS NOT NULL")
    )
    of_member = tokens.select("token", "node", "place", "size", "hub").join(inside, ["node", "hub"])
    member = of_member.select("token", "hub", F.col("node").alias("b"), F.col("place").alias("pb"), F.col("size").alias("n"), F.col("core").alias("cb"), F.col("apart").alias("db"))
    query = opened.join(tokens.select("token", "node", "place", "size"), "node").select(
        "token", "hub", F.col("node").alias("a"), F.col("place").alias("pa"), F.col("size").alias("m"), F.col("core").alias("ca"), F.col("apart").alias("da")
    )
    least = F.expr(_LEAST.format("m + n"))
    near = (
        query.join(member, ["hub", "token"])
        .filter((F.col("a") != F.col("b")) & comparable(F.col("m"), F.col("n")) & ~(F.col("ca") & F.col("cb")))
        .filter((F.col("m") - F.col("pa") >= least) & (F.col("n") - F.col("pb") >= least))
        .filter(F.abs(F.col("da") - F.col("db")) <= 1 - SIMILARITY / 100 + 1e-9)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("m") + F.col("n")).alias("sum"))
        .distinct()
    )
    near = keep(near, "near")
    more = in_common(near.select("a", "b"), bodies).join(near, ["a", "b"]).filter(F.col("both") * 100 >= (F.col("sum") - F.col("both")) * SIMILARITY).select("a", "b")

    roots = components(links.unionByName(more))
    of_node = sized.select("node", "key", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = of_node.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_key = keep(of_node.join(classes, "root").select("key", "component_id"), "classes")
    out = named(rows).join(by_key, "key", "left")
    return out.select(F.col("_id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"))


#: Shingles as text, pairs that share one, classes by their closure.
OP11_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w != '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, coalesce(list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END)), []) AS s
  FROM worded),
sets AS (SELECT md5(array_to_string(s, chr(10))) AS k, any_value(s) AS s, len(any_value(s)) AS n, min(doc_id) AS least FROM shingled WHERE len(s) > 0 GROUP BY 1),
tokens AS (SELECT k, n, unnest(s) AS t FROM sets),
pairs AS (
  SELECT a.k AS a, b.k AS b, a.n AS m, b.n AS n, count(*) AS shared FROM tokens a JOIN tokens b ON a.t = b.t AND a.k != b.k
  WHERE 100 * a.n >= {SIMILARITY} * b.n AND 100 * b.n >= {SIMILARITY} * a.n GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= {SIMILARITY} * (m + n - shared)),
reach(k, other) AS (SELECT k, k FROM sets UNION SELECT reach.k, links.b FROM reach JOIN links ON links.a = reach.other),
classes AS (SELECT reach.k, min(sets.least) AS component_id FROM reach JOIN sets ON sets.k = reach.other GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM shingled LEFT JOIN classes ON len(s) > 0 AND classes.k = md5(array_to_string(s, chr(10)))
"""


def op11_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join(table(spark, sf_dir, "documents"))
