"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole of it. In every chunk, filters
of ``WIDTH`` bytes slide over learned byte vectors; the largest response of each filter in the chunk is
kept. These pass a hidden layer; the mean and the largest of the hidden values over all chunks
of the document give one logit, hence one probability. A filter over byte vectors is a table of 256 numbers per
place, so scoring adds looked-up rows and never multiplies matrices of the text's size.

Training takes at most ``TRAIN_ROWS`` labelled documents, those with the smallest hashes, and of each at most
``TRAIN_CHUNKS`` chunks spread evenly over it; scoring reads every byte. The label is the only thing learned from
besides the text.

Nulls: a null text counts as empty and is scored as one chunk of padding; rows with a null label or
identifier are not trained on, but all rows are scored. Without labels of both kinds every score is the share of
label 1 (0.5 without any). Repeated rows each give a row. An empty table gives no rows. Extra columns
are left out and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, table, text_of

CHUNK, OVERLAP = 512, 64
#: Filter width and step in bytes, filters, hidden values, numbers in a byte's vector.
WIDTH, STEP, FILTERS, HIDDEN, VECTOR = 8, 2, 16, 12, 8
TRAIN_ROWS, TRAIN_CHUNKS, EPOCHS, BATCH, RATE = 3000, 6, 10, 64, 0.006
#: Share of training documents shown as a short piece only, since most have many chunks.
SHORTENED = 0.25
THRESHOLD = 0.7
_SLICE = 1 << 20


def chunks_of(raw: bytes, most: int | None = None) -> np.ndarray:
    """Overlapping chunks that cover all bytes, padded with zeros; ``most`` picks some evenly spread."""
    stride = CHUNK - OVERLAP
    count = max(1, -(-max(0, len(raw) - OVERLAP) // stride))
    starts = np.arange(count) * stride
    if most is not None and count > most:
        starts = starts[np.linspace(0, count - 1, most).astype(int)]
    padded = np.frombuffer(raw + bytes(CHUNK), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[starts]


@dataclass
class Network:
    vectors: np.ndarray  # byte -> vector
    filters: np.ndarray  # place in the filter, vector, filter
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray  # over mean and largest hidden values
    out_bias: np.ndarray
    constant: float | None = None

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            draw(0.5, 256, VECTOR),
            draw((WIDTH * VECTOR) ** -0.5 * 1.5, WIDTH, VECTOR, FILTERS),
            np.zeros(FILTERS, np.float32),
            draw(FILTERS**-0.5, FILTERS, HIDDEN),
            np.zeros(HIDDEN, np.float32),
            draw(HIDDEN**-0.5, 2 * HIDDEN),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """Filter responses, chunk x place x filter."""
        tables = np.einsum("bv,kvf->kbf", self.vectors, self.filters)
        tables[0] += self.bias
        places = (CHUNK - WIDTH) // STEP + 1
        total = np.zeros((len(chunks), places, FILTERS), np.float32)
        for k in range(WIDTH):
            total += tables[k][chunks[:, k : k + STEP * places : STEP][:, :places]]
        return total

    def logits(self, pooled: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
        """Logits of documents, and what the backward pass needs; ``owner`` is sorted and has every document."""
        active = np.maximum(pooled, 0)
        inner = np.tanh(active @ self.hidden + self.hidden_bias)
        first = np.searchsorted(owner, np.arange(docs))
        count = np.bincount(owner, minlength=docs).astype(np.float32)[:, None]
        mean = np.add.reduceat(inner, first) / count
        most = np.maximum.reduceat(inner, first)
        logit = np.concatenate([mean, most], axis=1) @ self.out + self.out_bias
        return logit, active, inner, mean, most, count

    def score(self, texts: list[str]) -> np.ndarray:
        """Probabilities of label 1."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        scores = []
        held: list[np.ndarray] = []
        sizes: list[int] = []

        def flush() -> None:
            pooled = np.concatenate(held)
            scores.append(self.logits(pooled, np.repeat(np.arange(len(sizes)), sizes), len(sizes))[0])
            held.clear()
            sizes.clear()

        for text in texts:
            chunks = chunks_of(text.encode("utf-8", "surrogatepass"))
            parts = [self.responses(chunks[i : i + 64]).max(axis=1) for i in range(0, len(chunks), 64)]
            held.append(np.concatenate(parts))
            sizes.append(len(chunks))
            if len(sizes) >= 4096:
                flush()
        if sizes:
            flush()
        return 1 / (1 + np.exp(-np.concatenate(scores).astype(np.float64))) if scores else np.zeros(0)

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss of a batch."""
        n = len(labels)
        response = self.responses(chunks)
        place = response.argmax(axis=1)
        pooled = np.take_along_axis(response, place[:, None], axis=1)[:, 0]
        logit, active, inner, mean, most, count = self.logits(pooled, owner, n)
        error = ((1 / (1 + np.exp(-logit)) - labels) / n).astype(np.float32)
        d_out = np.concatenate([mean, most], axis=1).T @ error
        d_mean, d_most = error[:, None] * self.out[:HIDDEN], error[:, None] * self.out[HIDDEN:]
        d_inner = (d_mean / count)[owner] + d_most[owner] * (inner == most[owner])
        d_before = d_inner * (1 - inner**2)
        d_active = (d_before @ self.hidden.T) * (pooled > 0)
        d_filters, d_vectors = np.zeros_like(self.filters), np.zeros_like(self.vectors)
        rows = np.arange(len(chunks))[:, None]
        for k in range(WIDTH):
            seen = chunks[rows, place * STEP + k]  # byte under place k of each filter at its largest response
            vectors = self.vectors[seen]
            d_filters[k] = np.einsum("cfv,cf->vf", vectors, d_active)
            np.add.at(d_vectors, seen, np.einsum("vf,cf->cfv", self.filters[k], d_active))
        return [d_vectors, d_filters, d_active.sum(0), active.T @ d_before, d_before.sum(0), d_out, error.sum(keepdims=True)]


def _shortened(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A piece of one chunk, as if it were the whole of a short document."""
    piece = np.zeros((1, CHUNK), np.uint8)
    chunk = chunks[rng.integers(len(chunks))]
    size = int(rng.integers(CHUNK // 8, CHUNK))
    piece[0, :size] = chunk[:size]
    return piece


def train(cut: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit to the chunks of each document by Adam."""
    network, y = Network.fresh(seed), np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        network.constant = float(y.mean()) if len(y) else 0.5
        return network
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    rng, step = np.random.default_rng(seed), 0
    total = epochs * -(-len(y) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            batch = order[i : i + BATCH]
            seen = [_shortened(cut[j], rng) if rng.random() < SHORTENED else cut[j] for j in batch]
            owner = np.repeat(np.arange(len(batch)), [len(c) for c in seen])
            grads = network.gradients(np.concatenate(seen), owner, y[batch])
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for p, g, (m, v) in zip(network.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, id_col: str, label: str, most: int) -> tuple[list[np.ndarray], list[int]]:
    """Chunks and labels of at most ``most`` documents outside the held-out part."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")
    )
    picked = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text).alias("_text"))
    joined = rows.join(F.broadcast(picked), "_id").groupBy("_id").agg(F.first("_label").alias("_label"), F.max("_text").alias("_text"))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only the chunks that are trained on travel to the driver."""
        for batch in slices(batches, "_text"):
            raw = [b"".join(c.tobytes() for c in chunks_of(t.encode("utf-8", "surrogatepass"), TRAIN_CHUNKS)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(raw, pa.binary())], ["_id", "_label", "chunks"])

    kind = joined.schema["_id"].dataType.simpleString()
    found = joined.mapInArrow(thin, f"_id {kind}, _label int, chunks binary").toPandas().sort_values("_id")
    return [np.frombuffer(c, np.uint8).reshape(-1, CHUNK) for c in found["chunks"]], [int(x) for x in found["_label"]]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", most: int = TRAIN_ROWS) -> Network:
    """A network for the labels given to some of the documents."""
    return train(*training_rows(docs, labels, text, id_col, label, most))


def classify(docs: DataFrame, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """(row, score): the columns ``keep`` of every document as a struct, and its probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed number of weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", _SLICE):
            scores = shared.value.score([t or "" for t in batch.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = classify(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
