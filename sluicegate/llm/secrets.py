"""Secret scan: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Two first-order models over the characters of a token are trained from labelled samples: what the
patterns find and digests of identifiers are random strings, all other tokens are ordinary
identifiers (words, numbers, addresses). A run of token characters outside the patterns' spans is a
secret when the logarithm of its likelihood as a random string exceeds that as an identifier by
``min_ratio``. Models have one number per pair of ASCII characters, so they go into the plan as a
literal. All work is done by DataFrame functions.

Positions count code points, ends are exclusive. Nulls: a null text counts as empty; a null identifier
is kept. Repeated rows each give a row. An empty table gives no rows and models without
counts, under which nothing is a secret but what the patterns find. Extra columns are left out and may have any
names. Texts are scanned whole whatever their length.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import sampled, table, text_of

# Patterns of the base rules and the least lengths of what they find.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "markov")

#: What the models look at: runs of token characters, of at least so many.
TOKEN = r"[A-Za-z0-9+/_=-]"
CANDIDATE_LEAST = 20
#: Documents with the smallest hashes whose tokens train the models.
SAMPLE_DOCS = 4000
#: Needed logarithm of the likelihood ratio, and what is added to each count.
MIN_RATIO = 12.0
SMOOTHING = 0.5
_SYMBOLS = 66
_BLOCK = 128


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; outside a lambda's own arguments, it would be for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, kind: str, least: int, group: int = 0) -> Column:
    """(start, rank, end) of all leftmost matches whose group has at least ``least`` characters.

    Matches and the gaps between them are taken apart by the same pattern, so that running lengths give the positions. They are
    added up in blocks of ``_BLOCK`` matches, then over blocks, as a growing array is copied with each element.
    """
    rank = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(found.alias("match"), checked.alias("checked"), F.split(text, pattern, -1).alias("gap"))
    size = lambda x: F.coalesce(F.char_length(x), F.lit(0))
    # one more gap than matches: the last one is left out
    pieces = F.transform(
        F.filter(zipped, lambda z: z["match"].isNotNull()),
        lambda z: F.struct(size(z["gap"]).alias("gap"), size(z["match"]).alias("size"), size(z["checked"]).alias("checked")),
    )
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + piece["gap"]
        end = begin + piece["size"]
        one = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(piece["checked"] >= least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def blocks(all_: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_) - 1, F.lit(0)) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * _BLOCK + 1, F.lit(_BLOCK)))

    def starts(cut: Column) -> Column:
        lengths = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), lambda n, piece: n + piece["gap"] + piece["size"]))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(lengths, zero, add, lambda acc: acc["out"])

    def placed(cut: Column) -> Column:
        begins = F.arrays_zip(cut.alias("block"), starts(cut).alias("at"))
        one = lambda b: F.aggregate(b["block"], F.struct(b["at"].alias("at"), nothing.alias("out")), step, lambda acc: acc["out"])
        return F.flatten(F.transform(begins, one))

    return _with(pieces, lambda all_: _with(blocks(all_), placed))


def _where(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int>>"))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed patterns; cheap tests first keep most texts away from the costly part."""
    return {
        "assign": _where(text.rlike(ASSIGN), spans(text, ASSIGN, "assign", ASSIGN_LEAST, 2)),
        "access": _where(text.contains("AKIA"), spans(text, ACCESS, "access", ACCESS_LEAST)),
        # A run of fewer characters is dropped anyway, and leaving it out changes no other match.
        "hex": _where(text.rlike("[0-9a-f]{%d}" % HEX_LEAST), spans(text, "[0-9a-f]{%d,}" % HEX_LEAST, "hex", HEX_LEAST)),
    }


def labelled_samples(docs: DataFrame, text: str = "text", id_col: str = "doc_id", most: int = SAMPLE_DOCS) -> DataFrame:
    """(token, random) out of ``most`` documents at most."""
    body = text_of(text)
    rows = sampled(docs.select(F.xxhash64(F.col(id_col)).alias("_order"), body.alias("_text")), "_order", most)
    secret = "(?:" + ASSIGN + "|" + ACCESS.replace("+", "{16,}") + "|[0-9a-f]{%d,})" % HEX_LEAST
    values = F.concat(
        F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("_text", F.lit("(?:AKIA[A-Z0-9]{16,}|[0-9a-f]{%d,})" % HEX_LEAST), F.lit(0)),
    )
    found = rows.select(F.explode(values).alias("token")).filter(F.char_length("token") >= HEX_LEAST)
    ordinary = (
        rows.select(F.explode(F.regexp_extract_all(F.regexp_replace("_text", secret, " "), F.lit(TOKEN + "{4,}"), F.lit(0))).alias("token"))
        .distinct()
    )
    digests = ordinary.select(F.base64(F.unhex(F.sha2("token", 256))).alias("token"))
    return (
        found.distinct()
        .withColumn("random", F.lit(True))
        .unionByName(digests.withColumn("random", F.lit(True)))
        .unionByName(ordinary.withColumn("random", F.lit(False)))
    )


def train(samples: DataFrame, token: str = "token", random: str = "random", smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters (place ``128 * first + second``), random over ordinary."""
    chars = F.split(F.col(token), "")
    pairs = F.transform(F.slice(chars, 1, F.size(chars) - 1), lambda c, i: F.ascii(c) * 128 + F.ascii(F.element_at(chars, i + 2)))
    counted = (
        samples.filter(F.char_length(token) >= 2)
        .select(F.col(random).alias("_random"), F.explode(pairs).alias("_pair"))
        .filter(F.col("_pair").between(0, 128 * 128 - 1))
        .groupBy("_random", "_pair")
        .count()
        .collect()  # at most two rows per pair of ASCII characters
    )
    logs = {}
    for kind in (True, False):
        own = {r["_pair"]: r["count"] for r in counted if r["_random"] is kind}
        first = [0] * 128
        for pair, n in own.items():
            first[pair // 128] += n
        logs[kind] = [math.log((own.get(p, 0) + smoothing) / (first[p // 128] + smoothing * _SYMBOLS)) for p in range(128 * 128)]
    return [a - b for a, b in zip(logs[True], logs[False])]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token of ASCII characters."""
    weights = F.split(F.lit(",".join(f"{w:.6f}" for w in model)), ",").cast("array<double>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        more = F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(weights, acc["last"] * 128 + code + 1))
        return F.struct(code.alias("last"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step, lambda acc: acc["sum"])


def scan_secrets(
    docs: DataFrame,
    model: list[float] | None = None,
    text: str = "text",
    id_col: str = "doc_id",
    min_ratio: float = MIN_RATIO,
    least: int = CANDIDATE_LEAST,
) -> DataFrame:
    """Per document: identifier, the spans of the patterns, and all spans with those of the models.

    Spans are (start, rank, end); ``KINDS[rank]`` names the kind. They are ordered by start, then kind.
    """
    model = model or train(labelled_samples(docs, text, id_col))
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text).alias("_text"))
    body = F.col("_text")
    base = rows.select("_id", "_text", F.array_sort(F.concat(*base_spans(body).values())).alias("base"))
    candidate = TOKEN + "{%d,}" % least
    runs = spans(body, candidate, "markov", least)
    tokens = F.regexp_extract_all("_text", F.lit(candidate), F.lit(0))
    scored = F.transform(F.arrays_zip(runs.alias("span"), tokens.alias("token")), lambda x: F.struct(x["span"].alias("span"), ratio(x["token"], model).alias("ratio")))
    chosen = F.transform(F.filter(scored, lambda x: x["ratio"] >= min_ratio), lambda x: x["span"])
    apart = base.withColumn("_more", _where(body.rlike(TOKEN + "{%d}" % least), chosen)).withColumn(
        "_more",
        F.filter("_more", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))),
    )
    return apart.select("_id", "base", F.array_sort(F.concat("base", "_more")).alias("spans")).withColumnRenamed("_id", id_col)


def listed(found: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["rank"] == KINDS.index(kind))).cast(T.LongType())


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count_of(F.col("spans"), "markov").alias("n_markov"),
    )
