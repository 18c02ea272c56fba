"""Exact and near duplicates, components, and the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest

from sluicegate.llm import exact_dedup, links, near_dedup
from sluicegate.llm.decontaminate import words


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize(("keep", "parts"), [("largest", 200), ("largest", 2), ("smallest", 2)])
def test_equal_texts_keep_one_identifier(spark, odd, texts, keep, parts):
    made = texts + [(100 + i, "Same") for i in range(50)] + [(200 + i, f"É {i % 3}") for i in range(9)] + [(300, "é 1")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    groups = defaultdict(list)
    for i, t in made:
        groups[lower(t)].append(-1 if i is None else i)
    rows = exact_dedup.content_sort_dedup(docs, keep=keep, parts=parts).collect()
    want = []
    for i, t in made:
        own = [x for x in groups[lower(t)] if x >= 0]
        best = max(own) if keep == "largest" else min(own)
        want.append((-1 if i is None else i, best, len(groups[lower(t)]), i == best, hashlib.sha256(lower(t).encode()).hexdigest()))
    got = [(-1 if r.doc_id is None else r.doc_id, r.keep_id, r.group_size, bool(r.kept), r.text_sha256) for r in rows]
    assert Counter(got) == Counter(want)


def test_equal_texts_of_nothing(nothing):
    assert exact_dedup.content_sort_dedup(nothing).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.content_sort_dedup(nothing, keep="first")


def test_no_second_shuffle_of_texts(odd):
    plan = exact_dedup.content_sort_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_text" not in plan


def shingles(text):
    w = words(text)
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / sum((x | y).values()) if x and y else float((a or "") == (b or ""))


def test_components_agree_with_paths(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rnd.randint(0, 60), 100 + rnd.randint(0, 60)) for _ in range(40)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r.node: r.root for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: top(x) for x in linked}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_are_unbiased_and_need_no_company():
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    body = [rnd.choice(vocabulary) for _ in range(300)]
    body += body[:100] * 2
    bodies = [" ".join(body)] + [" ".join(x if rnd.random() > p else rnd.choice(vocabulary) for x in body) for p in (0.005, 0.02, 0.05)]
    bodies += ["a b", "", "x " * 50, "x " * 45, None]
    found = near_dedup.shingles(bodies)
    many = near_dedup.signatures(*found, len(bodies), 4000)
    for k, text in enumerate(bodies):
        assert np.array_equal(many[k], near_dedup.signatures(*near_dedup.shingles([text]), 1, 4000)[0])
    for a, b in [(0, 1), (0, 2), (0, 3), (6, 7)]:
        assert abs((many[a] == many[b]).mean() - alike(bodies[a], bodies[b])) < 0.03


def test_groups_equal_brute_force(spark, odd, texts):
    """A hub with copies that are alike to it but not to each other, chains, exact copies, nulls."""
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(500)]
    hub = [rnd.choice(vocabulary) for _ in range(200)]
    made = [(100, " ".join(hub))]
    for i in range(60):
        copy = list(hub)
        for place in rnd.sample(range(5, 195), rnd.choice([1, 3, 4, 5])):
            copy[place] = f"new{i}x{place}"
        made.append((101 + i, " ".join(copy)))
    made += [(400 + i, " ".join(rnd.choice(vocabulary) for _ in range(60))) for i in range(30)] + [(500, " ".join(hub).upper() + "!")]
    rows = [(i, t) for i, t in texts if not t or len(t) < 100_000] + made
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if alike(rows[i][1], rows[j][1]) >= 0.8:
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(i)
    want = Counter()
    for own in groups.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        want.update((rows[i][0], min(ids), len(own)) for i in own)
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.near_duplicates(docs).collect())
    assert got == want


def test_blocks_link_what_is_apart():
    a, b, c = (np.array(x, "<u4").tobytes() for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4], [9, 9, 9]))
    node = lambda name, body: {"key": name, "root": name, "body": body}
    found = near_dedup.block_links([node(b"a", a)], [node(b"a", a), node(b"b", b), node(b"c", c)], 0.8)
    assert found == [(b"a", b"b")]
    assert near_dedup.weighted_jaccard(np.array([1, 1, 2], "<u4").tobytes(), np.array([1, 2, 2], "<u4").tobytes()) == 0.5
    assert near_dedup.block_links([node(b"c", b"")], [node(b"d", b"")], 0.8) == []


def test_near_groups_of_nothing(nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_each_stage_has_its_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontaminate", "packing"] and corpus_pipeline.ORACLE_SQL is None
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows
        rows = corpus_pipeline.staged(spark, stage(spark, rows, small), name)
        assert rows.columns == docs.columns
        was, now = ({r.doc_id: r.text for r in d.collect()} for d in (before, rows))
        assert now.items() <= was.items()
        gone = was.keys() - now.keys()
        if name == "quality":
            assert sum(labels.get(i, 1) for i in now) >= 0.95 * sum(labels.get(i, 1) for i in was)
        if name == "exact_dedup":
            best = {}
            for i, t in was.items():
                best[lower(t)] = max(i, best.get(lower(t), i))
            assert now.keys() == set(best.values())
        if name == "near_dedup":
            assert all(any(alike(was[i], was[j]) >= 0.8 for j in was if j != i) for i in gone)
            assert not any(alike(now[i], now[j]) >= 0.8 for i in now for j in now if i < j)
    pieces = corpus_pipeline.pack_windows(spark, rows, small).collect()
    assert {r.doc_id for r in pieces} == now.keys()


def test_stages_take_odd_and_no_rows(spark, odd, nothing, small):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(*plain), nothing.select(*plain)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, small).count() >= 0, name
