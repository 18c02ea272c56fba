"""Token ids as binary shards: frequency ranks in byte-aligned variable-length coding.

Every text is encoded, all ids of the corpus are counted, and an id is written as its rank by count
(ties by id), so the commonest ids take one byte. Four values share a control byte, two bits
each giving a value's length in bytes; control bytes and data bytes stand apart, which lets numpy
look a control byte's four lengths up in a table and place all values at once.

A shard holds consecutive documents in ascending order of their identifiers::

    4 bytes magic "SGT1" | 4 bytes header length | header: JSON {"ids": [...], "tokens": [...]}
    control bytes of each document in turn | data bytes of each document in turn

A document's control bytes are ceil(tokens / 4); spare places in the last one are zero and have no data.
``ranks.bin`` holds the id of each rank as little-endian unsigned 32-bit integers.

Nulls: a null text counts as empty (its end id is still written); null identifiers come first. Rows with
equal identifiers are all written, in the order of their ids' checksums. An empty table
gives no shard and no rows. Extra columns are left out and may have any names.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import discard, slices, staged, table, with_start
from sluicegate.llm.tokenize import binary, encoder, narrow
from sluicegate.session import work_dir

MAGIC = b"SGT1"
#: Ids of documents in one shard, about.
SHARD_TOKENS = 2_000_000
#: Lengths of the four values of each control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)
VOCABULARY = 50_257


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    four = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    four[: len(values)] = codes
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The values of all documents; ``counts`` has the number of each document's values."""
    padded = -(-counts // 4) * 4
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    owner = np.repeat(np.arange(len(counts)), padded)
    place = np.arange(len(lengths)) - np.repeat(np.cumsum(padded) - padded, padded)
    lengths = lengths[place < counts[owner]].astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def pack_shard(ids: list, tokens: list[int], controls: list[bytes], datas: list[bytes]) -> bytes:
    header = json.dumps({"ids": ids, "tokens": tokens}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *controls, *datas])


def unpack_shard(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Identifiers, numbers of ids, and ranks of all documents."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token shard")
    size = int.from_bytes(raw[4:8], "little")
    header = json.loads(raw[8 : 8 + size])
    counts = np.array(header["tokens"], np.int64)
    split = 8 + size + int((-(-counts // 4)).sum())
    return header["ids"], counts, decode_values(raw[8 + size : split], raw[split:], counts)


def _put(folder: str, name: str, raw: bytes) -> None:
    """Write a file whole: a repeated or killed attempt leaves no half of it under its name."""
    files, root = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)
    files.create_dir(root, recursive=True)
    attempt = f"{root}/_{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        out.write(raw)
    files.move(attempt, f"{root}/{name}")


def tokens_of(docs: DataFrame, text: str, id_col: str, tokenizer: str, folder: str | None, special_as_text: bool = False) -> DataFrame:
    """(_id, _crc, tokens): ids as unsigned 16-bit integers; a larger vocabulary is refused."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, folder, special_as_text)
        for batch in slices(batches, "_text"):
            ids, ends = coder.encode_column(batch.column("_text"))
            cuts = [0, *ends.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    binary(narrow(ids, coder.vocabulary), ends),
                ],
                ["_id", "_crc", "tokens"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(encode, f"_id {rows.schema['_id'].dataType.simpleString()}, _crc bigint, tokens binary")


def frequency_ranks(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Ids in descending order of their counts over the whole corpus; one number per id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])

    counted = tokens.select("tokens").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counted.toPandas()
    total = np.zeros(vocabulary, np.int64)
    total[rows["token"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return np.lexsort((np.arange(vocabulary), -total))


def write_shards(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    id_col: str = "doc_id",
    tokenizer: str = "byte_bpe_50k.json",
    tokenizers: str | None = None,
    vocabulary: int = VOCABULARY,
    shard_tokens: int = SHARD_TOKENS,
    special_as_text: bool = False,
) -> DataFrame:
    """Write all documents to ``folder``; returns one row per shard: part, shard, name, ids in it."""
    spark = docs.sparkSession
    path = work_dir(spark, "token-ids")
    tokens = staged(spark, tokens_of(docs, text, id_col, tokenizer, tokenizers, special_as_text), "token-ids", path)
    by_rank = frequency_ranks(tokens, vocabulary)
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    _put(folder, "ranks.bin", by_rank.astype("<u4").tobytes())
    shared = spark.sparkContext.broadcast(rank_of)  # one number per id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, held = TaskContext.get().partitionId(), 0, ([], [], [], [])

        def flush() -> pa.RecordBatch:
            nonlocal shard, held
            name = f"{part:07d}-{shard:07d}.sgt"
            _put(folder, name, pack_shard(*held))
            row = [part * 10_000_000 + shard, name, sum(held[1])]
            shard, held = shard + 1, ([], [], [], [])
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["shard", "name", "tokens"])

        for batch in batches:
            for name, raw in zip(batch.column("_id").to_pylist(), batch.column("tokens").to_pylist()):
                ids = np.frombuffer(raw, "<u2")
                for column, value in zip(held, (name, len(ids), *encode_values(shared.value[ids]))):
                    column.append(value)
                if len(held[0]) % 64 == 0 and sum(held[1]) >= shard_tokens or len(ids) >= shard_tokens:
                    yield flush()
        if held[0]:
            yield flush()

    # sampling the splitters reads the staged table; coding comes after the shuffle so that it runs once
    order = ["_id", "_crc"]
    ordered = tokens.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    shards = staged(spark, ordered.select("_id", "tokens").mapInArrow(write, "shard bigint, name string, tokens bigint"), "shards")
    discard(spark, path)
    return shards


def read_shards(spark: SparkSession, folder: str, shards: DataFrame, id_type: str = "bigint", with_ids: bool = True) -> DataFrame:
    """Documents out of the files: identifier, ids before it in all files, number of ids, their checksum, and the ids if asked for."""
    by_rank = np.frombuffer(bytes(spark.read.format("binaryFile").load(f"{folder}/ranks.bin").select("content").first()[0]), "<u4")
    shared = spark.sparkContext.broadcast(by_rank)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                part, shard = os.path.basename(path).removesuffix(".sgt").split("-")
                ids, counts, ranks = unpack_shard(raw)
                values = shared.value[ranks].astype("<u4")
                ends = np.cumsum(counts)
                texts = [values[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part) * 10_000_000 + int(shard)] * len(ids), pa.int64()),
                        pa.array([None if i is None else str(i) for i in ids], pa.string()),
                        pa.array(ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                        pa.array(texts if with_ids else [None] * len(ids), pa.binary()),
                    ],
                    ["shard", "_id", "_inside", "n_tokens", "ids_crc32", "ids"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*.sgt").load(folder).select("path", "content")
    rows = files.mapInArrow(decode, "shard bigint, _id string, _inside bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    starts = with_start(shards.select("shard", "tokens"), [], "shard", "tokens", "_before").select("shard", "_before")
    return rows.join(starts, "shard").select(
        F.col("_id").cast(id_type).alias("doc_id"), (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def op10_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "binary")
    shards = write_shards(docs, folder)
    if not shards.take(1):
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read_shards(spark, folder, shards, with_ids=False).drop("ids")
