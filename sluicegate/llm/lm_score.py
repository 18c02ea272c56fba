"""Stupid-backoff scores of documents under the bigram model of their own corpus.

A word (ASCII letters in lower case; other ASCII characters but digits and letters divide words) after another scores
``c(v w) / c(v)`` where the pair occurs at least ``MIN_COUNT`` times in the corpus, else ``ALPHA * c(w) / N``; a document's first word
comes after a start mark. A document's score is the sum of the natural logarithms, and the mean per word.
All counts are over all documents.

The counts are tables partitioned by hash and the documents' n-grams travel to them:

- words are counted first; the ``TOP`` commonest (so the table's size is bounded) are known to every task;
- pairs of two of the ``HOT`` commonest words are counted in a table of at most ``HOT ** 2`` numbers and scored where they stand,
  so the commonest pairs are never shuffled;
- all other pairs of a slice of documents go, once per document, to the bucket of their first word, or of the pair where the
  first word is one of the ``TOP``, so that no common word fills a bucket; all pairs with an equal hash meet there, are
  counted, joined to their counts and summed per document;
- words that are backed off to and are not among the ``TOP`` are joined to the table of word counts, then everything is
  summed by document.

The number of buckets follows the number of words, ``BUCKET_WORDS`` for each. Identifiers and lengths leave with the
pairs, so the texts are read three times (words, commonest pairs, all pairs) and scores need not go back to them.

Nulls: a null text has no words; its score is 0 and its mean null, as for a text without words. With ``per_row``, as
in the query, every row is a document and has the score of its own text, whatever its identifier; without, rows with
equal identifiers, also null ones, are scored as one document, each such row carries that score, and identifiers that
are not integers are told apart by hashes of 64 bits. An empty table gives no rows. Extra columns are left out and may
have any names. Texts are scored whole. N-grams are told apart by hashes of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, staged, table
from sluicegate.llm.hashing import BASE, mix, word_hashes

ALPHA, MIN_COUNT = 0.4, 2
TOP, HOT = 65_536, 1024
BUCKET_WORDS = 2_500_000
_SENT = ["bucket", "count", "body", "doc", "_id", "words"]
#: Stands before the first word of a document; no word's hash for certain, since words are hashed with their length.
START = np.uint64(0)


@dataclass
class Common:
    """The commonest words by hash, in ascending order, and the numbers of all."""

    words: np.ndarray
    counts: np.ndarray  # as a word
    contexts: np.ndarray  # before another word
    hot: np.ndarray  # place among the HOT commonest, or -1
    total: int

    def place(self, word: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""
        if not len(self.words):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        return np.where(self.words[at] == word, at, -1)


def _pairs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, second) of every word and what stands before it."""
    word, owner = word_hashes(texts)
    before = np.concatenate(([START], word[:-1])) if len(word) else word
    first = np.ones(len(word), bool)
    first[1:] = owner[1:] != owner[:-1]
    return owner, np.where(first, START, before).astype(np.uint64), word


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order and the sums of values."""
    different, place = np.unique(key, return_inverse=True)
    return different, *(np.bincount(place, v, len(different)) for v in values)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n, m): occurrences, and those before another word; the start mark has n = 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            _, before, word = _pairs(batch.column("_text").to_pylist())
            both = np.concatenate((word, before))
            ones, zeros = np.ones(len(word)), np.zeros(len(word))
            keys, n, m = _summed(both, np.concatenate((ones, zeros)), np.concatenate((zeros, ones)))
            yield pa.RecordBatch.from_arrays([_signed(keys), _signed(n), _signed(m)], ["word", "n", "m"])

    return rows.select("_text").mapInArrow(count, "word bigint, n bigint, m bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def common_words(counts: DataFrame, top: int, hot: int) -> Common:
    total = counts.agg(F.sum("n")).first()[0] or 0
    # the start mark always counts as common: every document has it
    rows = counts.orderBy((F.col("word") == 0).desc(), F.desc("n"), "word").limit(top).toPandas()
    words = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    rank = np.where(np.arange(len(words)) < hot, np.arange(len(words)), -1)
    return Common(words[order], rows["n"].to_numpy(np.int64)[order], rows["m"].to_numpy(np.int64)[order], rank[order], int(total))


def hot_pairs(rows: DataFrame, shared, hot: int) -> np.ndarray:
    """Counts of pairs of the commonest words: at most ``hot ** 2`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, total = shared.value, np.zeros(hot * hot, np.int64)
        for batch in slices(batches, "_text"):
            _, before, word = _pairs(batch.column("_text").to_pylist())
            x, y = common.place(before), common.place(word)
            x, y = np.where(x >= 0, common.hot[x], -1), np.where(y >= 0, common.hot[y], -1)
            both = (x >= 0) & (y >= 0)
            total += np.bincount(x[both] * hot + y[both], minlength=hot * hot)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([_signed(used), _signed(total[used])], ["pair", "n"])

    found = rows.select("_text").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(hot * hot, np.int64)
    out[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def _packed(before: np.ndarray, word: np.ndarray, doc: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs with documents and occurrences: different values of each column once, and their places, compressed."""
    order = np.lexsort((doc, word, before))
    parts, sizes = [], []
    for column in (before, word, doc):
        different, place = np.unique(column[order], return_inverse=True)
        parts += [different.astype("<i8" if column is doc else "<u8"), place.astype("<u2" if len(different) <= 65_536 else "<u4")]
        sizes.append(len(different))
    body = b"".join(p.tobytes() for p in [np.array(sizes, "<i8"), *parts, n[order].astype("<u4")])
    return zstandard.ZstdCompressor(level=3).compress(body)


def _unpacked(raw: bytes, count: int) -> tuple[np.ndarray, ...]:
    """First word, second word, document, occurrences."""
    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 24, []

    def take(kind: str, size: int) -> np.ndarray:
        nonlocal at
        begin, at = at, at + np.dtype(kind).itemsize * size
        return np.frombuffer(data[begin:at], kind)

    for kind, size in zip(("<u8", "<u8", "<i8"), np.frombuffer(data[:24], "<i8").tolist()):
        different = take(kind, size)
        out.append(different[take("<u2" if size <= 65_536 else "<u4", count)])
    return *out, take("<u4", count)


def _pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * BASE ^ word)


def score_documents(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", alpha: float = ALPHA, min_count: int = MIN_COUNT, top: int = TOP, hot: int = HOT, bucket_words: int = BUCKET_WORDS, per_row: bool = False, from_files: bool = False
) -> DataFrame:
    """Per row: identifier, number of words, sum of logarithms, and their mean per word.

    ``per_row`` scores each row by itself instead of the rows of an identifier together.
    """
    spark = docs.sparkSession
    integral = isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    # null and text identifiers get a number by hash
    number = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63) + 1)) if integral else F.xxhash64(F.col(id_col))
    doc = F.monotonically_increasing_id() if per_row else number
    named = docs.select(F.col(id_col).alias("_id"), doc.alias("_doc"), F.col(text).cast("string").alias("_text"))
    if per_row and not from_files:  # a repeated task must give each row its number again
        named = staged(spark, named, "lm-rows")
    rows = named.select("_doc", "_text")
    counts = staged(spark, word_counts(rows), "lm-words")
    common = common_words(counts, top, hot)
    buckets = max(1, math.ceil(common.total / bucket_words))
    shared = spark.sparkContext.broadcast(common)  # at most TOP words
    pairs = spark.sparkContext.broadcast(hot_pairs(rows, shared, hot))  # HOT ** 2 numbers

    def found_or_not(c: np.ndarray, context: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the score of each pair, and where the count of the second word is still to be added."""
        place = shared.value.place(second)
        known = np.log(np.where(place >= 0, shared.value.counts[place], 1).clip(1)) if len(shared.value.counts) else np.zeros(len(second))
        backed = math.log(alpha) - math.log(max(shared.value.total, 1)) + known
        found = c >= min_count
        return np.where(found, np.log(c.clip(1)) - np.log(context.clip(1)), backed), ~found & (place < 0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a slice, packed by bucket; bucket -1 has the documents and what is already scored."""
        common = shared.value
        for batch in slices(batches, "_text"):
            doc, before, word = _pairs(batch.column("_text").to_pylist())
            name = batch.column("_doc").to_numpy(zero_copy_only=False)
            sizes = np.bincount(doc, minlength=batch.num_rows)
            doc = name[doc] if len(doc) else np.zeros(0, np.int64)
            pair = _pair_hash(before, word)
            order = np.lexsort((doc, pair))
            pair, doc, before, word = pair[order], doc[order], before[order], word[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(pair)))
            pair, doc, before, word = pair[at], doc[at], before[at], word[at]
            x, y = common.place(before), common.place(word)
            p, q = (np.where(z >= 0, common.hot[z], -1) if len(common.hot) else z for z in (x, y))
            both = (p >= 0) & (q >= 0)
            here = np.flatnonzero(both)
            logs, _ = found_or_not(pairs.value[p[here] * hot + q[here]], common.contexts[x[here]] if len(here) else np.zeros(0), word[here])
            ids, total = _summed(doc[here], n[here] * logs)
            out: list[list] = [[-1], [len(ids)], [ids.tobytes() + total.tobytes()]]
            goal = (mix(np.where(x >= 0, pair, before) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)
            rest = np.flatnonzero(~both)
            rest = rest[np.argsort(goal[rest], kind="stable")]
            edges = np.searchsorted(goal[rest], np.arange(buckets + 1)) if buckets <= 4096 else None
            wanted = range(buckets) if edges is not None else np.unique(goal[rest]).tolist()
            for b in wanted:
                lo, hi = (edges[b], edges[b + 1]) if edges is not None else np.searchsorted(goal[rest], [b, b + 1])
                if hi > lo:
                    k = rest[lo:hi]
                    out[0].append(b)
                    out[1].append(len(k))
                    out[2].append(_packed(before[k], word[k], doc[k], n[k]))
            packed = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())]
            lack = lambda k, *kinds: [pa.nulls(k, kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([*packed, *lack(len(out[0]), pa.int64(), batch.column("_id").type, pa.int64())], _SENT)
            places = [pa.array(np.full(batch.num_rows, -1), pa.int64()), *lack(batch.num_rows, pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*places, batch.column("_doc"), batch.column("_id"), _signed(sizes)], _SENT)

    def meet(batch: pa.Table) -> pa.Table:
        """Count, join and sum the pairs of a bucket."""
        if batch.num_rows and batch.column("bucket")[0].as_py() < 0:
            named = batch.filter(pc.is_valid(batch.column("words")))
            scored = batch.filter(pc.is_valid(batch.column("body")))
            raws, sizes = scored.column("body").to_pylist(), scored.column("count").to_pylist()
            ids = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r, "<i8", c) for r, c in zip(raws, sizes))])
            total = np.concatenate([np.zeros(0), *(np.frombuffer(r, "<f8", c, 8 * c) for r, c in zip(raws, sizes))])
            ids, total = _summed(ids, total)
            return _rows(ids, total, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), named)
        parts = [_unpacked(r, c) for r, c in zip(batch.column("body").to_pylist(), batch.column("count").to_pylist())]
        before, word, doc, n = (np.concatenate([p[k] for p in parts]) for k in range(4))
        pair = _pair_hash(before, word)
        _, first, place = np.unique(pair, return_index=True, return_inverse=True)
        c = np.bincount(place, n).astype(np.int64)
        contexts, own = np.unique(before[first], return_inverse=True)
        known = shared.value.place(contexts)
        inside = np.bincount(own, c).astype(np.int64)  # a word outside the table has all its pairs here
        context = np.where(known >= 0, shared.value.contexts[known], inside)[own]
        logs, lacking = found_or_not(c, context, word[first])
        ids, total = _summed(doc, n * logs[place])
        late = np.flatnonzero(lacking[place])
        return _rows(ids, total, doc[late], word[late], n[late].astype(np.int64), batch.slice(0, 0))

    kind = named.schema["_id"]
    packed = [T.StructField("bucket", T.LongType()), T.StructField("count", T.LongType()), T.StructField("body", T.BinaryType())]
    own = [T.StructField("doc", T.LongType()), T.StructField("_id", kind.dataType), T.StructField("words", T.LongType())]
    sent = named.mapInArrow(send, T.StructType(packed + own))
    spread = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("body", "doc"), F.lit(buckets))).otherwise(F.lit(0))
    made = T.StructType([*own, T.StructField("score", T.DoubleType()), T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])
    partial = staged(spark, sent.groupBy("bucket", spread).applyInArrow(lambda batch: meet(batch), made), "lm-partial")
    late = partial.filter("word IS NOT NULL").join(counts.select("word", F.col("n").alias("c")), "word").select("doc", (F.col("n") * F.log("c")).alias("score"))
    scores = partial.filter("score IS NOT NULL").select("doc", "score").unionByName(late)
    documents = partial.filter("words IS NOT NULL").select("doc", "_id", "words")
    pooled = scores.unionByName(documents.select("doc", "words"), allowMissingColumns=True)
    pooled = pooled.groupBy("doc").agg(F.sum("words").alias("n_words"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"))
    return documents.select("doc", "_id").join(pooled, "doc").select(
        F.col("_id").alias(id_col), "n_words", F.col("score").alias("log_score"), F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).alias("per_word")
    )


def _rows(ids: np.ndarray, total: np.ndarray, doc: np.ndarray, word: np.ndarray, n: np.ndarray, named: pa.Table) -> pa.Table:
    """Sums per document, then words whose counts are still to be joined, then documents with their lengths."""
    parts = [
        {"doc": _signed(ids), "score": pa.array(total, pa.float64())},
        {"doc": _signed(doc), "word": _signed(word), "n": _signed(n)},
        {c: named.column(c) for c in ("doc", "_id", "words")},
    ]
    kinds = {"doc": pa.int64(), "_id": named.schema.field("_id").type, "words": pa.int64(), "score": pa.float64(), "word": pa.int64(), "n": pa.int64()}
    sizes = [len(p["doc"]) for p in parts]
    return pa.concat_tables(pa.table({c: p[c] if c in p else pa.nulls(k, kind) for c, kind in kinds.items()}) for p, k in zip(parts, sizes))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_documents(table(spark, sf_dir, "documents"), per_row=True, from_files=True)
    # sums depend on the order of adding in the last digits
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("per_word", 6).alias("per_word"))


OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
grams AS (SELECT row, CASE WHEN i > 1 THEN w[i - 1] ELSE '' END AS v, w[i] AS w FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
pairs AS (SELECT v, w, count(*) AS n FROM grams GROUP BY v, w),
contexts AS (SELECT v, sum(n) AS n FROM pairs GROUP BY v),
singles AS (SELECT w, sum(n) AS n FROM pairs GROUP BY w),
scored AS (
  SELECT p.v, p.w, ln(CASE WHEN p.n >= {MIN_COUNT} THEN p.n / c.n ELSE {ALPHA} * s.n / (SELECT sum(n) FROM pairs) END) AS log_score
  FROM pairs AS p JOIN contexts AS c ON p.v = c.v JOIN singles AS s ON p.w = s.w
),
sums AS (SELECT row, sum(log_score) AS log_score FROM grams JOIN scored USING (v, w) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(log_score, 0.0), 6) AS log_score,
  CASE WHEN len(w) > 0 THEN round(log_score / len(w), 6) END AS per_word
FROM d LEFT JOIN sums USING (row)
"""
