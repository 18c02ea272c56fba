"""The token-group matrix join against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import group_join

PLAIN = "doc_id long, text string, n_shingles string, key long, node string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "b") for i, t in rows], PLAIN).repartition(5)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    """(identifier, size, class) of every row, by comparing all pairs of different sets."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    nodes = list(set(sets))
    parent = list(range(len(nodes)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(nodes):
        for j, y in enumerate(nodes[:i]):
            if x and y and min(len(x), len(y)) * 100 >= 85 * max(len(x), len(y)) and 100 * len(x & y) >= 85 * len(x | y):
                parent[top(i)] = top(j)
    least, place = {}, {s: k for k, s in enumerate(nodes)}
    for (i, _), s in zip(rows, sets):
        root = top(place[s])
        if i is not None:
            least[root] = min(i, least.get(root, i))
    return Counter((i, len(s), least.get(top(place[s])) if s else i) for (i, _), s in zip(rows, sets))


def result(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def family(rnd, words, copies, edits):
    """Copies of one text, each with some words changed, moved, left out or added."""
    base = [rnd.choice(words) for _ in range(rnd.randint(60, 150))]
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            k = rnd.randrange(len(w))
            w[k : k + rnd.randint(0, 1)] = [rnd.choice(words)] * rnd.randint(0, 1)
        yield " ".join(w)


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed):
    """Loose and close copies, a passage in most texts, short texts, exact copies."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(3000)] + ["The", "of", "naïve", "x,"]
    passage = " ".join(rnd.choice(words) for _ in range(40))
    texts = [t for edits in (1, 2, 3, 4, 5, 6, 9) for t in family(rnd, words, 45, edits)]
    texts += [f"{t} {passage}" if k % 3 else f"{passage} {t[:60]}" for k, t in enumerate(texts[:150])]
    texts += [" ".join(rnd.choice(words[:4]) for _ in range(rnd.randint(0, 8))) for _ in range(150)]
    texts += [passage, passage.upper(), f"{passage} end"] * 20
    rows = [(k if k % 9 else None, t) for k, t in enumerate(rnd.sample(texts, len(texts)))]
    assert result(group_join.group_join(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark, odd, texts):
    assert result(group_join.group_join(odd)) == brute(texts)


def test_same_identifier_for_different_texts(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    rows = [(1, a), (1, b), (0, b), (None, a), (None, "x"), (None, "x"), (None, None), (5, " \t\n"), (5, "")]
    assert result(group_join.group_join(frame(spark, rows))) == brute(rows)


def test_nothing(spark, nothing):
    assert group_join.group_join(nothing).collect() == []


def test_chains_reach_the_smallest(spark):
    """Each text is linked with the next only: the class is the whole chain."""
    words = [f"w{k}" for k in range(400)]
    rows = [(100 - k, " ".join(words[2 * k : 2 * k + 60])) for k in range(60)]
    want = brute(rows)
    assert result(group_join.group_join(frame(spark, rows))) == want and {c[2] for c in want} == {41}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=200), st.lists(st.integers(0, 400), max_size=12))
def test_first_tokens_of_linked_sets_meet(x, changes):
    """The bound behind the matrix and the places."""
    x, y = sorted(x), sorted(x ^ set(changes))
    if 100 * len({*x} & {*y}) < 85 * len({*x} | {*y}):
        return
    first = lambda s: s[: len(s) - group_join.least_common(len(s)) + 1 + group_join.extra(len(s))]
    assert len({*first(x)} & {*first(y)}) >= 1 + group_join.extra(group_join.least_common(len(x)))
    least = -(-85 * (len(x) + len(y)) // 185)
    common = min({*x} & {*y})
    assert len(x) - x.index(common) >= least and len(y) - y.index(common) >= least


def test_bits(spark):
    numbers = [0, 1, -1, 2**40 + 7, -(2**63)]
    bits = group_join.bitmap(spark.createDataFrame([(n,) for n in numbers], "v long"))
    held = group_join._in(bits, np.array([*numbers, 5, 2**24 + 3], np.int64).view(np.uint64))
    assert held.tolist() == [True] * 5 + [False] * 2
