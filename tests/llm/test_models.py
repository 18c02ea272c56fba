"""Classifier, language model, chats."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sluicegate.llm import chat, quality
from sluicegate.llm import lm_score as lm
from sluicegate.llm.decontaminate import words


def test_chunks_cover_every_byte():
    for size in (0, 1, 511, 512, 513, 960, 961, 5000):
        raw = bytes(1 + i % 250 for i in range(size))
        chunks, stride = quality.chunks_of(raw), quality.CHUNK - quality.OVERLAP
        seen = np.zeros(len(chunks) * stride + quality.CHUNK, np.uint8)
        for k, chunk in enumerate(chunks):
            seen[k * stride : k * stride + quality.CHUNK] = chunk
        assert bytes(seen[:size]) == raw and not seen[size:].any()


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    network = quality.Network.fresh(3)
    chunks = rng.integers(1, 255, (5, quality.CHUNK)).astype(np.uint8)
    owner, labels = np.array([0, 0, 1, 2, 2]), np.array([1, 0, 1], np.float32)

    def loss():
        logit = network.logits(network.responses(chunks).max(axis=1), owner, 3)[0].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(logit)) - labels * logit))

    for p, g in zip(network.parameters(), network.gradients(chunks, owner, labels)):
        flat, slope = p.reshape(-1), g.reshape(-1)
        at = int(np.abs(slope).argmax())
        old, step = flat[at], 2e-3
        flat[at] = old + step
        up = loss()
        flat[at] = old - step
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * step) - slope[at]) < 0.1 * abs(slope[at]) + 1e-3


def test_held_out_accuracy():
    folder = "/root/testdata/sf0.1"
    labels = pq.read_table(f"{folder}/labels.parquet").to_pandas().set_index("doc_id")["quality"]
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    docs = docs[docs["doc_id"].isin(labels.index)]
    out = docs["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    learn, test = docs[~out].iloc[:1500], docs[out].iloc[:600]
    cut = [quality.chunks_of((t or "").encode(), quality.TRAIN_CHUNKS) for t in learn["text"]]
    network = quality.train(cut, labels[learn["doc_id"]].tolist())
    score, y = network.score([t or "" for t in test["text"]]), labels[test["doc_id"]].to_numpy()
    assert ((score >= quality.THRESHOLD) == (y == 1)).mean() > 0.95
    good, bad = score[y == 1], score[y == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.97


def test_scores_of_odd_rows(spark, odd, nothing, texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    network = quality.fit(odd, labels)
    rows = quality.classify(odd, network, odd.columns).select("row.*", F.col("score").alias("p")).collect()
    assert len(rows) == len(texts) and all(0 <= r.p <= 1 for r in rows)
    assert rows[0].asDict().keys() >= {"_id", "_text", "score", "key", "row"}
    alone = {t or "": float(network.score([t or ""])[0]) for _, t in texts}
    assert all(abs(alone[r.text or ""] - r.p) < 1e-5 for r in rows)
    assert quality.classify(nothing, network, ["doc_id"]).count() == 0
    assert quality.fit(odd, labels.limit(0)).constant == 0.5
    assert quality.fit(odd, labels.filter("quality = 1")).constant == 1.0


def backoff(bodies):
    singles, pairs, before = Counter(), Counter(), Counter()
    split = [words(b) for b in bodies]
    for w in split:
        two = list(zip([None, *w[:-1]], w))
        singles.update(w)
        pairs.update(two)
        before.update(v for v, _ in two)
    total = sum(singles.values())
    one = lambda v, w: math.log(pairs[v, w] / before[v]) if pairs[v, w] >= 2 else math.log(lm.ALPHA * singles[w] / total)
    return [(len(w), sum(one(v, x) for v, x in zip([None, *w[:-1]], w))) for w in split]


def test_backoff_scores_equal_plain_counts(spark, odd, nothing, texts):
    want = Counter()
    pooled = {}
    for (i, _), (n, score) in zip(texts, backoff([t for _, t in texts])):
        old = pooled.get(i, (0, 0.0))
        pooled[i] = (old[0] + n, old[1] + score)
    for options in ({}, {"top": 4, "hot": 2, "bucket_words": 5000}):
        rows = lm.score_documents(odd, **options).collect()
        assert len(rows) == len(texts)
        for r in rows:
            n, score = pooled[r.doc_id]
            assert r.n_words == n and abs(r.log_score - score) < 1e-6 * max(1, abs(score))
            assert (r.per_word is None) == (n == 0)
        want.update(r.doc_id for r in rows)
    assert want[4] == 4  # the repeated row, in both runs
    assert lm.score_documents(nothing).count() == 0
    named = odd.withColumn("name", F.concat(F.lit("d"), F.col("doc_id").cast("string"))).select("name", "text")
    assert {(r.name, r.n_words) for r in lm.score_documents(named, id_col="name").collect()} == {(None if i is None else f"d{i}", n) for i, (n, _) in pooled.items()}


def test_every_participant_is_the_assistant_once(spark):
    rows = [
        ("c", 0, "system", "rules"),
        ("c", 1, "ann", "hi <|im_end|>"),
        ("c", 2, "bob", None),
        ("c", 3, None, "who?"),
        ("c", 3, None, "who?"),
        ("c", 70, "ann", "😀 late"),
        (None, None, "zed", "alone"),
        ("only", 1, "system", "nobody"),
    ]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumn("segment", F.lit(9)).withColumn("_parts", F.lit("x"))
    got = {(r.conv_id, r.perspective, r.segment): r for r in chat.perspectives(turns).collect()}
    assert set(got) == {("c", p, s) for p in ("ann", "bob", "unknown") for s in (0, 1)} | {(None, "zed", -1)}
    first = got["c", "ann", 0]
    assert first.rendered == (
        "<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi <\\|im_end|><|im_end|>\n"
        "<|im_start|>user name=bob\n<|im_end|>\n" + "<|im_start|>user name=unknown\nwho?<|im_end|>\n" * 2  # said twice
    )
    assert [first.rendered[m.start : m.end] for m in first.mask] == ["hi <\\|im_end|><|im_end|>"]
    second = got["c", "ann", 1]
    assert second.start == len(first.rendered) and [second.rendered[m.start : m.end] for m in second.mask] == ["😀 late<|im_end|>"]
    assert got["c", "bob", 1].mask == [] and got[None, "zed", -1].rendered == "<|im_start|>assistant\nalone<|im_end|>\n"
    assert chat.perspectives(turns.limit(0)).count() == 0
