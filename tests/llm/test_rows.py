"""Null and repeated identifiers: every row counts by itself."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import exact_dedup, lm_score, near_dedup, packing
from sluicegate.llm.decontaminate import words

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def plain(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src0", 1) for i, t in rows], PLAIN).repartition(3)


def left(stage, spark, rows, folder):
    return Counter((r.doc_id, r.text) for r in stage(spark, plain(spark, rows), folder).collect())


@pytest.fixture(scope="module")
def bodies():
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    return [" ".join(rnd.choice(vocabulary) for _ in range(100)) for _ in range(6)]


def test_one_row_of_each_text_stays(spark, small, bodies):
    a, b, c, d, e, _ = bodies
    rows = [(None, a), (None, b), (1, b), (3, b.upper()), (2, c), (2, c), (2, c), (3, d), (None, e), (None, e)]
    want = Counter([(None, a), (3, b.upper()), (2, c), (3, d), (None, e)])
    assert left(corpus_pipeline.drop_copies, spark, rows, small) == want


def test_one_row_of_each_near_group_stays(spark, small, bodies):
    a, b, c, d, e, f = bodies
    rows = [(11, a), (10, f"{a} new"), (None, f"{a} other"), (None, b), (12, c), (12, c), (12, d), (None, e), (None, e), (10, f)]
    want = Counter([(10, f"{a} new"), (None, b), (12, c), (12, d), (None, e), (10, f)])
    assert left(corpus_pipeline.drop_near_copies, spark, rows, small) == want


def test_only_contaminated_rows_go(spark, small, bodies):
    item = max((r.text or "" for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()), key=len)
    rows = [(None, item), (None, bodies[0]), (7, item), (7, bodies[1]), (8, bodies[2]), (8, bodies[2])]
    assert left(corpus_pipeline.drop_contaminated, spark, rows, small) == Counter([rows[1], rows[3], rows[4], rows[5]])


def test_changed_copies_without_identifiers_are_found(spark, bodies):
    a, b, c, d, *_ = bodies
    rows = [(None, a), (None, f"{a} new"), (None, b), (5, c), (None, f"{c} new"), (None, f"{c} new"), (6, d)]
    found = Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.near_duplicates(plain(spark, rows)).collect())
    assert found == Counter([(None, None, 2)] * 2 + [(None, None, 1), (5, 5, 3), (None, 5, 3), (None, 5, 3), (6, 6, 1)])


def test_each_row_has_the_score_of_its_text(spark, bodies):
    a, b, *_ = bodies
    rows = [(None, a), (None, f"{a} {a}"), (None, None), (1, b), (1, b), (2, a), (3, ""), (4, f"{a} {a}")]
    named = lm_score.score_documents(plain(spark, rows).withColumn("doc_id", F.struct("doc_id", "text")), per_row=True).collect()
    assert Counter((r.doc_id.doc_id, r.doc_id.text) for r in named) == Counter(rows)
    scores = defaultdict(set)
    for r in named:
        assert r.n_words == len(words(r.doc_id.text)) and (r.per_word is None) == (r.n_words == 0)
        scores[r.doc_id.text or ""].add(round(r.log_score, 6))
    assert all(len(x) == 1 for x in scores.values()) and scores[""] == {0.0} and scores[a] != scores[f"{a} {a}"]


def test_query_scores_rows_alone(spark, tmp_path, bodies):
    rows = [(None, bodies[0]), (None, f"{bodies[1]} more"), (1, bodies[2]), (1, bodies[2])]
    plain(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.n_words) for r in lm_score.op3_lm_score(spark, str(tmp_path)).collect())
    assert got == Counter([(None, 100), (None, 101), (1, 100), (1, 100)])


def test_numbers_need_not_be_written_for_rows_from_files(spark, tmp_path, bodies):
    rows = [(None, bodies[0]), (None, f"{bodies[0]} more"), (1, None), (1, bodies[2]), (2, "")]
    plain(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    one, other = (lm_score.score_documents(docs, per_row=True, from_files=x).collect() for x in (True, False))
    plainly = lambda found: sorted((r.doc_id or 0, r.n_words, round(r.log_score, 9)) for r in found)
    assert plainly(one) == plainly(other) and len(one) == len(rows)


def test_copies_without_identifiers_are_dealt_out(spark, bodies):
    rows = [(None, bodies[0])] * 600 + [(7, bodies[0])] * 300 + [(8, bodies[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], PLAIN).repartition(7)
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.content_sort_dedup(docs, parts=20).collect())
    assert found == Counter({(None, 7, 900, False): 600, (7, 7, 900, True): 300, (8, 8, 1, True): 1})


def test_many_sources_have_queues_of_their_own():
    totals = {f"s{i}": 4096 for i in range(2000)}
    assert len(set(packing.queues_of(totals, None, 4096).values())) == 2000


def test_sources_that_share_a_queue_are_mixed(spark):
    """Small sources of many documents, and of one, spread over all windows."""
    rnd = random.Random(8)
    body = lambda n: " ".join(rnd.choice(["the", "of", "and", "to"]) for _ in range(n))
    rows = [(i, body(200), "en", "big", 1) for i in range(150)]
    rows += [(1000 + i, body(9), "en", f"small{i % 12}" if i % 12 else None, 1) for i in range(240)]
    rows += [(2000 + i, body(9), "en", f"one{i}", 1) for i in range(60)]
    pieces = packing.pack(spark.createDataFrame(rows, PLAIN).repartition(3), length=32).collect()
    source = {r[0]: r[3] for r in rows}
    windows = 1 + max(r.sequence_id for r in pieces)
    place = defaultdict(list)
    for r in pieces:
        name = source[r.doc_id]
        place["one" if name and name.startswith("one") else name] += [r.sequence_id / windows] * r.length
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    for name, at in place.items():
        for k in range(1, 4):
            assert abs(sum(x < k / 4 for x in at) / len(at) - k / 4) < (0.25 if name == "one" else 0.12), (name, k)
