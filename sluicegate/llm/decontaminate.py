"""Benchmark decontamination with a generalised suffix automaton over words.

The words of all test items go into one automaton (one per ``shard_words`` words of items, so that
an automaton stays small however many items there are). Documents stream through it word by
word: the state follows the longest suffix of the words read that occurs in any item, and its length
tells whether a window of ``window`` words, or a whole shorter item, ends here. Words inside such
an occurrence are hit. A document is contaminated when it has hits and they make up at least
``1 / coverage`` of its words; ``remove_spans`` cuts the hit spans out instead.

A word that occurs in no item cannot be part of an occurrence, so only runs of known words that are
long enough for the shortest window are streamed; this is exact.

Nulls: a null text has no words and is clean; an item with a null or empty text has no window. A null
item identifier counts as the text ``''`` in the hash. Items with the same words are all counted.
Repeated rows, also with equal identifiers, each give a row. Empty tables give no rows, respectively
no hits. Extra columns are left out of the result and may have any names. Long texts are
processed whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, table

WINDOW = 13
COVERAGE = 20
#: Words of items in one automaton.
SHARD_WORDS = 500_000
#: A-Z become lower case, other ASCII characters that are not digits or letters become blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters, lower-cased, and of any other characters above ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items behind each window.

    ``step`` maps the words known to small integers, 0 to none of them. State 0 is the root.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        kept = []
        for name, item in items:
            if item:
                coded = [self.ids.setdefault(w, len(self.ids) + 1) for w in item]
                kept.append((name, coded))
                last = 0
                for word in coded:
                    last = self._extend(last, word)
        self.shortest = min((min(len(c), window) for _, c in kept), default=0)
        #: Items that own a window ending in a state, and the short items with their lengths.
        self.window_items: dict[int, set[str]] = {}
        self.short_items: dict[int, dict[int, set[str]]] = {}
        for name, coded in kept:
            self._note(name, coded)
        #: For each state the nearest of its suffixes, itself included, at which a short item ends, or 0.
        self.short_end = [0] * len(self.length)
        if self.short_items:
            for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                self.short_end[state] = state if state in self.short_items else self.short_end[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._new(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            target = self.next[at][word]
            self.link[state] = target if self.length[at] + 1 == self.length[target] else self._split(at, word, target)
        return state

    def _new(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """A copy of ``target`` for its suffixes up to one word longer than ``at``."""
        copy = self._new(self.length[at] + 1, dict(self.next[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def advance(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest suffix of the words read that occurs in an item."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        found = self.next[state].get(word)
        return (0, 0) if found is None else (found, matched + 1)

    def holding(self, state: int, length: int) -> int:
        """The state of the suffix of ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _note(self, name: str, coded: list[int]) -> None:
        state = matched = 0
        short = len(coded) < self.window
        for word in coded:
            state, matched = self.advance(state, matched, word)
            if not short and matched >= self.window:
                state, matched = self.holding(state, self.window), self.window
                self.window_items.setdefault(state, set()).add(name)
        if short:
            own = self.short_items.setdefault(self.holding(state, len(coded)), {})
            own.setdefault(len(coded), set()).add(name)

    def occurrences(self, coded: list[int], base: int) -> Iterator[tuple[int, int, set[str]]]:
        """(start, end, items) of each occurrence of a window in a run of known words.

        No longer match than a window is followed, so that a step climbs one link at most besides those that shorten the match.
        """
        state = matched = 0
        for i, word in enumerate(coded):
            state, matched = self.advance(state, matched, word)
            if matched >= self.window:
                state, matched = self.holding(state, self.window), self.window
                if state in self.window_items:
                    yield base + i + 1 - self.window, base + i + 1, self.window_items[state]
            at = self.short_end[state]
            while at > 0:
                for length, names in self.short_items[at].items():
                    if length <= matched:
                        yield base + i + 1 - length, base + i + 1, names
                at = self.short_end[self.link[at]]

    def hits(self, doc: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans, possibly overlapping, and the items they come from."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.shortest or len(doc) < self.shortest:
            return spans, items
        coded = list(map(self.ids.get, doc, [0] * len(doc)))
        unknown = np.flatnonzero(np.fromiter(coded, np.int32, len(coded)) == 0)
        starts = np.concatenate(([0], unknown + 1))
        ends = np.concatenate((unknown, [len(coded)]))
        for k in np.flatnonzero(ends - starts >= self.shortest):
            a, b = int(starts[k]), int(ends[k])
            for start, end, names in self.occurrences(coded[a:b], a):
                spans.append((start, end))
                items |= names
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def build(benchmark: DataFrame, item: str, text: str, window: int, shard_words: int) -> list[Broadcast]:
    """Automata of all items, each of about ``shard_words`` words, so that no broadcast grows with the items.

    Items come to the driver in order, one shard at a time.
    """
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("_item"), F.col(text).cast("string").alias("_text"))
    automata, shard, size = [], [], 0
    for row in rows.orderBy("_item", "_text").toLocalIterator():
        shard.append((row["_item"], words(row["_text"])))
        size += len(shard[-1][1])
        if size >= shard_words:
            automata.append(context.broadcast(Automaton(shard, window)))
            shard, size = [], 0
    if shard:
        automata.append(context.broadcast(Automaton(shard, window)))
    return automata


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: int = COVERAGE,
    max_span: int | None = None,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, contaminated, and the text without hit spans.

    ``clean_text`` leaves out hit spans of more than ``max_span`` words (by default, all) of
    contaminated documents and equals the text of the others.
    """
    automata = build(benchmark, item, item_text, window, shard_words)
    limit = -1 if max_span is None else max_span

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out: list[list] = [[], [], [], [], [], [], []]
            for body in batch.column("_text").to_pylist():
                doc = words(body)
                spans: list[tuple[int, int]] = []
                items: set[str] = set()
                for shared in automata:
                    more, names = shared.value.hits(doc)
                    spans += more
                    items |= names
                union = merged(spans)
                hit = sum(b - a for a, b in union)
                dirty = hit > 0 and coverage * hit >= len(doc)
                digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
                clean = remove_spans(body, union, limit) if dirty else body
                for column, value in zip(out, (len(doc), hit, len(items), digest, dirty, [list(s) for s in union], clean)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    *(pa.array(out[i], pa.int64()) for i in range(3)),
                    pa.array(out[3], pa.string()),
                    pa.array(out[4], pa.bool_()),
                    pa.array(out[5], pa.list_(pa.list_(pa.int64()))),
                    pa.array(out[6], pa.string()),
                ],
                ["_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "clean_text"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    made = T.StructType([rows.schema["_id"]])
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"), ("contaminated", "boolean")):
        made.add(name, kind)
    found = rows.mapInArrow(scan, made.add("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))).add("clean_text", "string"))
    return found.withColumnRenamed("_id", "doc_id")


def remove_spans(text: str | None, spans: list[tuple[int, int]], longer_than: int = -1) -> str | None:
    """The text without the words of the given spans and what stands between those words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    kept, at = [], 0
    for start, end in spans:
        if end - start > longer_than:
            kept.append(raw[at : places[start][0]])
            at = places[end - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least({WINDOW}, len(w)) AS n, w[i : i + least({WINDOW}, len(w)) - 1] AS g
  FROM b, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
places AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS g
  FROM d, (SELECT DISTINCT n FROM windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
),
found AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {COVERAGE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def brute_force(doc: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, int, str]:
    """The same by comparing every window with every place, for tests."""
    split = words(doc)
    hit, names = set(), set()
    for name, body in items:
        item = words(body)
        size = min(window, len(item))
        windows = sorted({tuple(item[i : i + size]) for i in range(len(item) - size + 1)}) if size else []
        for i in range(len(split) - size + 1 if size else 0):
            place = tuple(split[i : i + size])
            k = bisect_left(windows, place)
            if k < len(windows) and windows[k] == place:
                hit |= set(range(i, i + size))
                names.add(name)
    return len(split), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
