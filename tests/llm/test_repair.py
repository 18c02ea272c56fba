"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import repair

KIND = "conv_id long, turn long, role string, text string, h string, seen string, part int"


def cheapest(rows):
    """(cost, audit, lines) by search in order of cost, then audit; rows of (role, text, fault)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    after = {0: ("user", 2), 1: ("user", 2), 3: ("user", 2), 2: ("assistant", 3)}
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    while True:
        cost, audit, i, s, lines = heapq.heappop(heap)
        if i == len(rows) and s in (0, 3):
            return cost, audit, lines
        if (i, s) in seen:
            continue
        seen.add((i, s))
        role, to = after[s]
        heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*lines, f"{role}:")))
        if i < len(rows):
            name, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s, lines))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, to, (*lines, f"{role}:{text}")))
                if (name[:1], s) in keep:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, keep[name[:1], s], (*lines, f"{name}:{text}")))


def brute(table, hurt=True):
    """What the query should return for rows of (conv, turn, role, text)."""
    rows = []
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {conv: (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for conv, *_ in table}
    for conv in out:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        judged, seen = [], set()
        for _, role, text in own:
            bare = re.sub(r"[ \t-\r]+$", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        if not judged:
            continue
        turns = {t for t, *_ in own if t is not None}
        count = lambda f: sum(x[2] == f for x in judged)
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (conv, gaps, count("blank"), count("duplicate"), count("truncated"), bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1) for r in rows], KIND).repartition(3)


def talk(rnd, conv, n, turns=None):
    roles = ["user", "assistant", "system", "tool", "", "unknown", None]
    texts = ["Hello.", "Yes.", "no", " \t", "", None, "naïve 😀?", "x" * 30, "end!  \n"]
    weights = [6, 6, 2, 1, 1, 1, 1]
    return [(conv, turns[k] if turns else k, rnd.choices(roles, weights)[0], rnd.choice(texts) or f"t{k}." if rnd.random() < 0.9 else None) for k in range(n)]


@pytest.fixture(scope="module")
def odd_talks():
    rnd = random.Random(5)
    rows = [r for c in range(60) for r in talk(rnd, c, rnd.randint(1, 12))]
    rows += talk(rnd, 100, 9, [None, None, 1, 1, 1, 5, 5, 9, None]) + [(101, None, None, None)] * 3 + talk(rnd, None, 7)
    rows += talk(rnd, 102, 300) + [(103, 4, "user", "Same.")] * 40 + [(104, 2**63 - 1, "user", "A."), (104, -(2**63) + 5, "assistant", "B.")]
    lost = [(c, t) for c in range(200, 400) for t in range(2) if not zlib.crc32(f"{c}:{t}".encode()) % 20]
    return rows + [(c, t, "user", "Gone.") for c, t in lost] + [(500, 0, "user", "word " * 200_000)]


def test_odd_rows(spark, odd_talks):
    want = brute(odd_talks)
    beyond = [w for w in want if w[1] >= 2**63]
    want = sorted(((*w[:1], None, *w[2:]) if w in beyond else w for w in want), key=str)
    assert any(not w[7] for w in want)
    assert result(repair.repaired(frame(spark, odd_talks))) == want


def test_conversations_over_many_blocks(spark, odd_talks):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd_talks if c != 104]
    for most in (1, 7):
        assert result(repair.repair(spark.createDataFrame(rows, KIND.split(", h")[0]).repartition(5), most)) == brute(rows, hurt=False)


def test_one_conversation_over_many_tasks(spark):
    rnd = random.Random(6)
    rows = [(1, k, rnd.choice(["user", "user", "assistant"]), rnd.choice(["Yes.", f"Answer {k}.", f"cut {k}"])) for k in range(4000)] + talk(rnd, 2, 5) + talk(rnd, 0, 5)
    assert result(repair.repaired(frame(spark, rows))) == brute(rows)


def test_nothing(spark):
    assert repair.repaired(frame(spark, [(1, 1, "user", "x")]).limit(0)).collect() == []


def test_other_kinds_of_identifiers(spark):
    rows = [("a", 0, "user", "Hi."), ("b", 1, "assistant", "Yo."), (None, 1, "user", "x")]
    got = repair.repaired(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert result(got) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.sampled_from(["", "blank", "truncated"])), max_size=9))
def test_edits_are_the_least(rows):
    named = [({"s": "system", "u": "user", "a": "assistant", "t": "tool"}[i], f"x{k}", f) for k, (i, f) in enumerate(rows)]
    symbols = bytes(repair.symbol(i, f) for i, f in rows)
    steps, state = repair.unroll(symbols, repair.END, 0)
    steps += repair.closing(state)
    lines = tuple(repair.edited(steps, [r[0] for r in named], [r[1] for r in named]))
    assert (repair.before(symbols, repair.END)[0][0], "".join(s for s, _ in steps), lines) == cheapest(named)


@given(st.lists(st.integers(0, 8), max_size=60), st.integers(0, 60))
def test_products_of_runs_are_products_of_rows(symbols, cut):
    whole = repair.UNIT
    for s in symbols:
        whole = repair.multiply(whole, repair.power(s, 0))
    parts = [bytes(symbols[:cut]), bytes(symbols[cut:])]
    assert repair.multiply(repair.matrix(parts[0]), repair.matrix(parts[1])) == whole == repair.matrix(bytes(symbols))
    after = repair.END
    assert repair.before(bytes(symbols), after)[0] == repair.apply(whole, after)


def test_long_runs_take_powers():
    """Every second of a million users becomes an assistant."""
    assert repair.before(bytes([repair.symbol("u", None)]) * 1_000_000, repair.END)[0][0] == 1_000_000
