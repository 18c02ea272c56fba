"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

The patterns give the base spans, which always stay. Around every digit or at-sign, a zone of tokens is
looked at by the model: each candidate span of at most ``MOST_TOKENS`` tokens is scored for each type by features
of the span as a whole (its shape, number of digits, checksum, range of its parts, what stands next to it), every token
outside spans by its class, and dynamic programming over the ends of spans picks the best division of
the zone into typed spans and other tokens. What it finds apart from base spans is added.

It is trained by the likelihood of whole divisions (forward and backward sums over all of them) on at most
``TRAIN_ZONES`` zones with their base spans; copies of phone numbers without their plus sign are added so that the
model goes beyond the patterns.

Positions count code points, ends are exclusive. Nulls: a null text is empty; a null identifier is kept.
Repeated rows each give a row. An empty table gives no rows; without zones to train on nothing
is added to the base spans. Extra columns are left out and may have any names. Texts are read whole,
and all patterns take time in proportion to them.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import sampled, slices, table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # rank of the kind, start, end

# The base patterns. An email is looked for from its at-sign, so that long runs cost no more than short ones;
# a number's runs of digits are taken whole, which is what leftmost greedy matching does.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Tokens on each side of a digit or at-sign, and in a span at most.
CONTEXT, MOST_TOKENS = 3, 24
TRAIN_ZONES, EPOCHS, RATE, DECAY, SLOTS = 900, 6, 0.4, 1e-4, 4096
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\n|[^\s]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns by kind, then start."""
    found: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at) if start < at else None
            if domain:
                end = domain.end()
                found.append((0, start, end))
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def zones(text: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens near digits and at-signs, as (start, end) of each token; line ends divide zones."""
    out: list[list[tuple[int, int]]] = []
    for line in re.finditer(r"[^\n]+", text):
        body = line[0]
        if "@" not in body and not _DIGIT.search(body):
            continue
        tokens = [(m.start() + line.start(), m.end() + line.start()) for m in _TOKEN.finditer(body)]
        marked = [i for i, (a, _) in enumerate(tokens) if text[a] == "@" or "0" <= text[a] <= "9"]
        last = -1
        for i in marked:
            first, stop = max(0, i - CONTEXT), min(len(tokens), i + CONTEXT + 1)
            if out and first <= last:
                out[-1] += tokens[last:stop]
            else:
                out.append(tokens[first:stop])
            last = stop
        # zones of different lines never join
        last = -1
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % SLOTS


def span_features(text: str, start: int, end: int) -> list[int]:
    """Features of a span as a whole."""
    body = text[start:end]
    digits = _digits(body)
    shape = re.sub(r"[^\W\d_]+", "a", body)
    exact = re.sub(r"[0-9]+", lambda m: f"<{min(len(m[0]), 20)}>", shape)
    loose = re.sub(r"[0-9]+", "d", shape)
    parts = body.split(".")
    before, after = text[start - 1 : start], text[end : end + 1]
    names = [
        "bias",
        f"shape {loose[:40]}",
        f"exact {exact[:40]}",
        f"digits {min(len(digits), 24)}",
        f"at {body.count('@')}",
        f"dots {min(body.count('.'), 6)}",
        f"plus {body[:1] == '+'}",
        f"blanks {min(body.count(' '), 4)}",
        f"before {'edge' if not before or before.isspace() else 'word' if before.isalnum() else before}",
        f"after {'edge' if not after or after.isspace() else 'word' if after.isalnum() else after}",
    ]
    if len(digits) == len(body.replace(" ", "").replace("-", "")):
        names.append(f"sum {min(len(digits), 24)} {luhn(digits)}")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        names.append(f"range {all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    return [_slot(n) for n in names]


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first token, token after the last) of spans with a digit or at-sign, from and to a name, number, plus or bracket."""
    marks = [text[a] == "@" or "0" <= text[a] <= "9" for a, _ in tokens]
    counted = np.concatenate(([0], np.cumsum(marks))).tolist()
    out = []
    for i, (a, _) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        for j in range(i + 1, min(len(tokens), i + MOST_TOKENS) + 1):
            last = text[tokens[j - 1][0]]
            if counted[j] > counted[i] and (last.isalnum() or last == ")"):
                out.append((i, j))
    return out


class SpanModel:
    """Weights of span features by type, and of tokens outside spans by class."""

    def __init__(self) -> None:
        self.spans = np.zeros((SLOTS, len(KINDS)))
        self.spans[_slot("bias")] = -2.0
        self.outside = np.zeros(3)
        self.trained = False

    @staticmethod
    def classes(text: str, tokens: list[tuple[int, int]]) -> list[int]:
        return [1 if "0" <= text[a] <= "9" else 2 if text[a] == "@" else 0 for a, _ in tokens]

    def best(self, text: str, tokens: list[tuple[int, int]]) -> list[Span]:
        """The most likely division of a zone."""
        ending: dict[int, list[tuple[int, float, int]]] = {}
        for i, j in candidates(text, tokens):
            scores = self.spans[span_features(text, tokens[i][0], tokens[j - 1][1])].sum(axis=0)
            kind = int(scores.argmax())
            ending.setdefault(j, []).append((i, float(scores[kind]), kind))
        total, back = [0.0], [None]
        for j, c in enumerate(self.classes(text, tokens), 1):
            value, choice = total[j - 1] + self.outside[c], None
            for i, score, kind in ending.get(j, ()):
                if total[i] + score > value:
                    value, choice = total[i] + score, (i, kind)
            total.append(value)
            back.append(choice)
        out, j = [], len(tokens)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((kind, tokens[i][0], tokens[j - 1][1]))
                j = i
        return out[::-1]

    def fit(self, examples: list[tuple[str, list[tuple[int, int]], list[Span]]], epochs: int = EPOCHS, seed: int = 5) -> SpanModel:
        """Raise the likelihood of the given divisions; spans that no candidate covers are left out."""
        ready = []
        for text, tokens, gold in examples:
            starts, ends = {a: i for i, (a, _) in enumerate(tokens)}, {b: j for j, (_, b) in enumerate(tokens, 1)}
            wanted = {(starts[a], ends[b]): kind for kind, a, b in gold if a in starts and b in ends}
            spans = candidates(text, tokens)
            features = [np.array(span_features(text, tokens[i][0], tokens[j - 1][1])) for i, j in spans]
            ready.append((spans, features, self.classes(text, tokens), wanted))
        rng = np.random.default_rng(seed)
        grown, grown_out = np.full_like(self.spans, 1e-6), np.full(3, 1e-6)
        for _ in range(epochs):
            for k in rng.permutation(len(ready)):
                spans, features, classes, wanted = ready[k]
                if not spans:
                    continue
                scores = np.array([self.spans[f].sum(axis=0) for f in features])
                weights, outside = np.exp(np.clip(scores, -30, 30)), np.exp(np.clip(self.outside, -30, 30))
                sums = weights.sum(axis=1).tolist()
                n = len(classes)
                by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
                for s, (i, j) in enumerate(spans):
                    by_end[j].append((i, sums[s]))
                    by_start[i].append((j, sums[s]))
                ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
                for j in range(1, n + 1):
                    ahead[j] = ahead[j - 1] * outside[classes[j - 1]] + sum(ahead[i] * w for i, w in by_end[j])
                for i in range(n - 1, -1, -1):
                    behind[i] = behind[i + 1] * outside[classes[i]] + sum(behind[j] * w for j, w in by_start[i])
                if not math.isfinite(ahead[n]) or ahead[n] <= 0:
                    continue
                covered = [False] * n
                for i, j in wanted:
                    covered[i:j] = [True] * (j - i)
                slope_out = np.zeros(3)
                for i, c in enumerate(classes):
                    slope_out[c] += (0 if covered[i] else 1) - ahead[i] * outside[c] * behind[i + 1] / ahead[n]
                grown_out += slope_out**2
                self.outside += RATE * slope_out / np.sqrt(grown_out)
                for s, (i, j) in enumerate(spans):
                    slope = -weights[s] * (ahead[i] * behind[j] / ahead[n])
                    if (i, j) in wanted:
                        slope[wanted[i, j]] += 1
                    if np.abs(slope).max() > 1e-4:
                        f = features[s]
                        grown[f] += slope**2
                        self.spans[f] += RATE * (slope - DECAY * self.spans[f]) / np.sqrt(grown[f])
        self.trained = bool(ready)
        return self


def training_zones(docs: DataFrame, text: str, id_col: str, most: int) -> list[tuple[str, list[tuple[int, int]], list[Span]]]:
    """At most ``most`` zones, those with the smallest hashes, with their base spans."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out: list[list] = [[], []]
            for body in batch.column("_text").to_pylist():
                for tokens in zones(body or "")[:64] if body else ():
                    piece = body[max(0, tokens[0][0] - 1) : tokens[-1][1] + 1]
                    if len(piece) <= 400:
                        out[0].append(zlib.crc32(piece.encode("utf-8", "surrogatepass")))
                        out[1].append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], ["place", "piece"])

    body = F.col(text).cast("string")
    rows = docs.select(F.xxhash64(F.col(id_col), body).alias("_order"), body.alias("_text"))
    some = sampled(rows.filter(F.col("_text").rlike("[0-9@]")), "_order", 4 * most)
    picked = some.select("_text").mapInArrow(cut, "place bigint, piece string").distinct().orderBy("place", "piece").limit(most)
    examples = []
    for k, row in enumerate(picked.collect()):
        pieces = [row["piece"]]
        if k % 3 == 0 and any(kind == 3 for kind, *_ in base_spans(row["piece"])):
            pieces.append(None)
        for piece in pieces:
            if piece is None:  # the same phone number without its plus sign
                kind, a, b = next(s for s in base_spans(row["piece"]) if s[0] == 3)
                piece = row["piece"][:a] + row["piece"][a + 1 :]
                gold = [s for s in base_spans(piece) if s[0] != 2] + [(3, a, b - 1)]
            else:
                gold = base_spans(piece)
            for tokens in zones(piece):
                inside = [s for s in gold if tokens[0][0] <= s[1] and s[2] <= tokens[-1][1]]
                taken: list[Span] = []
                for s in sorted(inside, key=lambda s: (s[1] - s[2], s)):  # of overlapping base spans the longest
                    if all(s[2] <= t[1] or t[2] <= s[1] for t in taken):
                        taken.append(s)
                examples.append((piece, tokens, taken))
    return examples


def more_spans(text: str, base: list[Span], model: SpanModel) -> list[Span]:
    """What the model finds apart from base spans."""
    out: list[Span] = []
    if not model.trained or "@" not in text and not _DIGIT.search(text):
        return out
    starts, ends = [], []
    for _, a, b in sorted(base, key=lambda s: s[1]):  # their union, as disjoint spans in order
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    met = lambda a, b: bisect_left(starts, b) > bisect_right(ends, a)  # noqa: E731  whether a base span has a part of a:b
    for tokens in zones(text):
        free = any((text[a] == "@" or "0" <= text[a] <= "9") and not met(a, a + 1) for a, _ in tokens)
        if free:  # else nothing that could be found is apart from base spans
            out += [s for s in model.best(text, tokens) if not met(s[1], s[2])]
    return out


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id", most: int = TRAIN_ZONES) -> SpanModel:
    return SpanModel().fit(training_zones(docs, text, id_col, most))


def find_personal_data(docs: DataFrame, model: SpanModel, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: identifier, base spans by kind and start, and all spans likewise, as (rank of the kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.int64()))
        for batch in slices(batches, "_text"):
            out: list[list] = [[], []]
            for body in batch.column("_text").to_pylist():
                base = base_spans(body or "")
                out[0].append([list(s) for s in base])
                out[1].append([list(s) for s in sorted(base + more_spans(body or "", base, shared.value))])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(out[0], kind), pa.array(out[1], kind)], ["_id", "base", "spans"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    spans = "array<array<bigint>>"
    found = rows.mapInArrow(find, f"_id {rows.schema['_id'].dataType.simpleString()}, base {spans}, spans {spans}")
    return found.withColumnRenamed("_id", id_col)


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, (s[0] + 1).cast("int")), s[1].cast("string"), s[2].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def _counted(found: Column, rank: int) -> Column:
    return F.size(F.filter(found, lambda s: s[0] == rank)).cast("bigint")  # a second argument would be the place in the array


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, fit(docs))
    return found.select(
        "doc_id",
        *(_counted(F.col("base"), rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )


def brute_force(text: str | None) -> str:
    """Digest of the base spans by the patterns as they stand, for tests."""
    text, out = text or "", []
    out += [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(_digits(m[0])) <= 15]
    return hashlib.sha256(",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out).encode()).hexdigest()
