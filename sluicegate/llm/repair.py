"""Repair of conversation structure: the cheapest edits that make the roles read ``(s?(ua)+)?``, found by run-length min-plus products.

Rows of a conversation are ordered by turn (null first), then role, then the MD5 of the text. A row has one of nine symbols: it must go
(blank or duplicate), or one of the initials s, u, a, other, each with or without a cut-off end. A symbol is a 4x4 min-plus
matrix over what stands so far: nothing, s, an open u, a closed pair. Equal neighbouring symbols are one run, and a run of length L
is passed by the cached binary powers of its matrix. Costs to go are worked out from the end, then the choices are unrolled
from the start, taking the ASCII-least letter that keeps the least cost.

Rows are range-partitioned by conversation and place, so one conversation may spread over many tasks. A conversation that
lies within one task and one block is finished there. Any other is a row of blocks of at most ``BLOCK_ROWS`` rows: their matrices (16 numbers a block) are
multiplied from the end to give each block its costs to go, then blocks are unrolled in order, streaming, with one
block and the audit in memory.

Nulls: role and text count as one space, a null turn comes first, a null conversation is one of its own. A role without
letters has an empty initial. Repeated rows (same turn, role and text) are duplicates but for one. A conversation that
damage leaves without rows has zeros and an empty audit; an empty table has no rows; long texts are used whole; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import slices, staged, table

BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 20
WHITE = " \t\n\x0b\x0c\r"
INFINITE = 1 << 60
RESULTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
DELETE, INSERT, REROLE, KEEP = 3, 2, 2, 0

# What stands so far: 0 nothing, 1 s, 2 an open u, 3 a closed pair.
_USER, _ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
_NEXT = {"s": {0: 1}, "u": _USER, "a": _ASSISTANT, "o": {}}
_ANY = _USER | _ASSISTANT
#: A symbol is 0 for a row that must go, else 1 + 2 * place of its initial here, and 1 more if its end is cut off.
_INITIALS = "suao"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def symbol(initial: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return 0
    return 1 + 2 * _INITIALS.index(initial if initial in ("s", "u", "a") else "o") + (fault == "truncated")


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(INFINITE, *(row[k] + b[k][j] for k in range(4))) for j in range(4)) for row in a)


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(INFINITE, *(row[k] + v[k] for k in range(4))) for row in a)


def _edges(edges: dict[tuple[int, int], int]) -> Matrix:
    return tuple(tuple(edges.get((i, j), INFINITE) for j in range(4)) for i in range(4))


UNIT = _edges({(i, i): 0 for i in range(4)})
_ONE_INSERT = _edges({(i, i): 0 for i in range(4)} | {(i, j): INSERT for i, j in _ANY.items()})
#: More than two inserts in a row hold a pair that can be left out.
INSERTS = multiply(_ONE_INSERT, _ONE_INSERT)
#: Costs after the last row: nothing or a closed pair may stand.
END: Vector = apply(INSERTS, (0, INFINITE, INFINITE, 0))


@cache
def _parts(sym: int) -> tuple[dict[int, int], bool]:
    """Where keeping the row leads to, and whether its end is cut off."""
    return ({}, False) if not sym else (_NEXT[_INITIALS[(sym - 1) // 2]], sym % 2 == 0)


@cache
def power(sym: int, k: int) -> Matrix:
    """The matrix of 2^k rows of a symbol."""
    if k:
        return multiply(power(sym, k - 1), power(sym, k - 1))
    keep, cut = _parts(sym)
    edges = {(i, i): DELETE for i in range(4)}
    for moves, cost in ((keep, KEEP + cut), (_ANY if sym else {}, REROLE + cut)):
        for i, j in moves.items():
            edges[i, j] = min(cost, edges.get((i, j), INFINITE))
    return multiply(INSERTS, _edges(edges))


def runs(symbols: bytes) -> list[tuple[int, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def _bits(length: int) -> Iterator[int]:
    return (k for k in range(length.bit_length()) if length >> k & 1)


def matrix(symbols: bytes) -> Matrix:
    """The product over all rows, run by run."""
    out = UNIT
    for sym, length in runs(symbols):
        for k in _bits(length):
            out = multiply(out, power(sym, k))
    return out


def before(symbols: bytes, after: Vector) -> list[Vector]:
    """Costs to go at the start of each run, and at the end."""
    out = [after]
    for sym, length in reversed(runs(symbols)):
        for k in _bits(length):
            after = apply(power(sym, k), after)
        out.append(after)
    return out[::-1]


def unroll(symbols: bytes, after: Vector, state: int) -> tuple[list[tuple[str, int]], int]:
    """(letter, state after it) of the edits up to the last row, and the state there."""
    at = before(symbols, after)
    out = []
    for (sym, length), end in zip(runs(symbols), at[1:]):
        keep, cut = _parts(sym)
        inside = [end]
        for _ in range(length - 1):
            inside.append(apply(power(sym, 0), inside[-1]))
        goes = apply(power(sym, 0), inside[-1])
        for rest in reversed(inside):
            taken = False
            while not taken:
                left = goes[state]
                if DELETE + rest[state] == left:
                    letter, to, taken = "D", state, True
                elif state in _ANY and INSERT + goes[_ANY[state]] == left:
                    letter, to = "I", _ANY[state]
                elif state in keep and KEEP + cut + rest[keep[state]] == left:
                    letter, to, taken = "K", keep[state], True
                else:
                    letter, to, taken = "R", _ANY[state], True
                out.append((letter, to))
                state = to
            goes = rest
    return out, state


def closing(state: int) -> list[tuple[str, int]]:
    """The inserts after the last row."""
    out = []
    while END[state]:
        state = _ANY[state]
        out.append(("I", state))
    return out


def edited(steps: list[tuple[str, int]], roles: list[str], texts: list[str]) -> Iterator[str]:
    """The lines ``role:text`` that edits leave of some rows."""
    row = 0
    for letter, state in steps:
        role = "user" if state == 2 else "assistant"
        if letter == "I":
            yield f"{role}:"
            continue
        if letter != "D":
            yield f"{role if letter == 'R' else roles[row]}:{texts[row]}"
        row += 1


class Writer:
    """Audit and hash of one conversation, edit by edit."""

    def __init__(self) -> None:
        self.audit, self.hash, self.lines = [], hashlib.sha256(), 0

    def add(self, steps: list[tuple[str, int]], roles: list[str], texts: list[str]) -> None:
        self.audit.append("".join(s for s, _ in steps))
        for line in edited(steps, roles, texts):
            self.hash.update((("\n" if self.lines else "") + line).encode("utf-8", "surrogatepass"))
            self.lines += 1


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by the checksum of conversation and turn; null roles and texts are one space."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), kind.alias("kind"), copies.alias("copies")
    ).filter("kind != 0").select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """Rows with the MD5 of their text and whether role and text occur at an earlier turn of the conversation."""
    hashed = rows.withColumn("h", F.md5(F.encode("text", "utf-8")))
    place = F.struct(F.col("turn").alias("turn"))
    several = (
        hashed.groupBy("conv_id", "role", "h")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("g"), F.col("first.turn").alias("first_turn"))
    )
    same = hashed["conv_id"].eqNullSafe(several["c"]) & (hashed["role"] == several["r"]) & (hashed["h"] == several["g"])
    earlier = F.col("r").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return hashed.join(several, same, "left").select("conv_id", "turn", "role", "text", "h", earlier.alias("seen"))


class Block:
    """Consecutive rows of one conversation."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.roles, self.texts, self.symbols, self.size = conv, [], [], bytearray(), 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.first_turn, self.last_turn = 0, 0, None, None

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if duplicate else None if bare[-1] in ".!?" else "truncated"
        if fault:
            self.counts[fault] += 1
        if self.roles:
            self.illegal += illegal(self.roles[-1], role)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.roles.append(role)
        self.texts.append(text)
        self.symbols.append(symbol(role[:1], fault))
        self.size += len(text)

    def full(self, most: int) -> bool:
        return len(self.roles) >= most or self.size >= BLOCK_BYTES


def illegal(left: str, right: str) -> bool:
    return left[:1] + right[:1] not in ("su", "ua", "au")


def _gaps(first: int | None, last: int | None, turns: int) -> int | None:
    gaps = 0 if first is None else last - first + 1 - turns
    return gaps if gaps < 2**63 else None


_BLOCKS = f"part int, seq bigint, closed boolean, {RESULTS}, turns bigint, first_turn bigint, last_turn bigint, symbols binary, matrix array<bigint>, roles array<string>, texts array<string>"


def _names(ddl: str) -> list[str]:
    return [field.split(" ")[0] for field in ddl.split(", ")]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{k: r.get(k) for k in schema.names} for r in rows], schema)


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _schema(batch: pa.RecordBatch, ddl: str) -> pa.Schema:
    fields = [(name, _KINDS[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))]
    return pa.schema([("conv_id", batch.schema.field("conv_id").type), *fields])


def _into_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition; conversations that begin and end inside it in one block are finished."""
    part = TaskContext.get().partitionId()
    seq, block, begun_here, previous, out, pending = 0, None, False, None, [], 0

    def done(closed: bool) -> None:
        nonlocal seq, pending
        row = {"conv_id": block.conv, "part": part, "seq": seq, "closed": closed, **block.counts, "illegal": block.illegal}
        if closed:
            after = END
            steps, state = unroll(bytes(block.symbols), after, 0)
            writer = Writer()
            writer.add(steps + closing(state), block.roles, block.texts)
            row |= {"gaps": _gaps(block.first_turn, block.last_turn, block.turns), "cost": before(bytes(block.symbols), after)[0][0]}
            row |= {"audit": "".join(writer.audit), "repaired_sha256": writer.hash.hexdigest()}
        else:
            row |= {"turns": block.turns, "first_turn": block.first_turn, "last_turn": block.last_turn, "symbols": bytes(block.symbols)}
            row |= {"matrix": [x for line in matrix(bytes(block.symbols)) for x in line], "roles": block.roles, "texts": block.texts}
            pending += block.size
        seq += 1
        out.append(row)

    fresh = True  # the first conversation of a partition may have begun in another
    for batch in slices(batches, "text", BLOCK_BYTES):
        schema = _schema(batch, _BLOCKS)
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "h", "seen")]
        for conv, turn, role, text, h, seen in zip(*columns):
            key = (conv, turn, role, h)
            if block is None or conv != block.conv:
                if block is not None:
                    done(begun_here)
                    fresh = False
                block, begun_here = Block(conv), not fresh
            elif block.full(most):
                done(False)
                block, begun_here = Block(conv), False
            block.add(turn, role, text, seen or key == previous)
            previous = key
            if len(out) >= 1000 or pending >= BLOCK_BYTES:
                yield _batch(out, schema)
                out, pending = [], 0
    if block is not None:
        done(False)
        yield _batch(out, schema)


def _costs_to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs to go after each block, the last block of a conversation first."""
    conv, after, started = None, END, False
    for batch in batches:
        out = []
        for now, product in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist()):
            if not started or now != conv:
                conv, after, started = now, END, True
            out.append(list(after))
            after = apply(tuple(tuple(product[i : i + 4]) for i in range(0, 16, 4)), after)
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("seq"), pa.array(out, pa.list_(pa.int64()))], ["part", "seq", "after"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of several blocks in order."""
    schema, row, writer, state, last = None, None, None, 0, None

    def finished() -> dict:
        writer.add(closing(state), [], [])
        gaps = _gaps(row["first_turn"], row["last_turn"], row["turns"])
        return row | {"gaps": gaps, "audit": "".join(writer.audit), "repaired_sha256": writer.hash.hexdigest()}

    for batch in batches:
        schema = _schema(batch, RESULTS)
        for i in range(batch.num_rows):
            new = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if row is None or new["conv_id"] != row["conv_id"]:
                if row is not None:
                    yield _batch([finished()], schema)
                row = {k: new[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")}
                row["cost"] = before(new["symbols"], tuple(new["after"]))[0][0]
                writer, state = Writer(), 0
            else:
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    row[name] += new[name]
                row["illegal"] += illegal(last, new["roles"][0])
                row["turns"] += new["turns"] - (row["last_turn"] is not None and row["last_turn"] == new["first_turn"])
                row["first_turn"] = new["first_turn"] if row["first_turn"] is None else row["first_turn"]
                row["last_turn"] = row["last_turn"] if new["last_turn"] is None else new["last_turn"]
            steps, state = unroll(new["symbols"], tuple(new["after"]), state)
            writer.add(steps, new["roles"], new["texts"])
            last = new["roles"][-1]
    if row is not None:
        yield _batch([finished()], schema)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation that has rows: gaps, faults, cheapest edits and the hash of what they leave.

    ``rows`` has ``conv_id, turn, role, text``, without null roles and texts.
    """
    spark = rows.sparkSession
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    order = ["conv_id", "turn", "role", "h"]
    placed = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = staged(spark, placed.mapInArrow(lambda b: _into_blocks(b, block_rows), f"{conv}, {_BLOCKS}"), "repair-blocks")
    results = ["conv_id", *_names(RESULTS)]
    split = blocks.filter("NOT closed")
    products = split.select("conv_id", "part", "seq", "matrix").repartition("conv_id")
    to_go = products.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq")).mapInArrow(_costs_to_go, "part int, seq bigint, after array<bigint>")
    in_order = split.join(to_go, ["part", "seq"]).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    joined = in_order.mapInArrow(_joined, f"{conv}, {RESULTS}")
    return blocks.filter("closed").select(results).unionByName(joined)


def repaired(conversations: DataFrame) -> DataFrame:
    """Every conversation of a table after damage and repair."""
    found = repair(damage(conversations)).withColumnRenamed("conv_id", "c")
    ids = conversations.select("conv_id").distinct()
    nothing: dict[str, Column] = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    value = lambda name: F.when(F.col("cost").isNull(), nothing.get(name, F.lit(0).cast("bigint"))).otherwise(F.col(name)).alias(name)
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["c"]), "left")
    return joined.select("conv_id", *(value(name) for name in _names(RESULTS)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


def _crc_table() -> str:
    """A list of the 256 remainders, from the polynomial."""
    value = "c"
    for _ in range(8):
        value = f"list_transform([{value}], lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)[1]"
    return f"list_transform(range(256), lambda c: {value})"


#: Forward: the best (cost, audit) for each state, row by row of all conversations.
OP12_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_crc_table()} AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS k
  FROM conversations),
summed AS (
  SELECT keyed.*, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(length(k) // 2), lambda i: ('0x' || substr(k, 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]))) % 20 AS kind
  FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM summed, (SELECT unnest([1, 2]) AS copy) WHERE kind != 0 AND (copy = 1 OR kind = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS ini, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS following,
    CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
moves(s, ini, s2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
chains(s, s2, c, letters, added) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'), (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'),
  (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
dp(conv_id, n, s, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '', '' FROM damaged
  UNION ALL
  SELECT conv_id, n, s, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) AS place FROM (
      SELECT dp.conv_id, j.n, o.s2 AS s, dp.cost + ch.c + o.c AS cost, dp.audit || ch.letters || o.letter AS audit, dp.lines || ch.added || o.line AS lines
      FROM dp JOIN judged j ON j.conv_id IS NOT DISTINCT FROM dp.conv_id AND j.n = dp.n + 1
      JOIN chains ch ON ch.s = dp.s,
      LATERAL (
        SELECT ch.s2 AS s2, 3 AS c, 'D' AS letter, '' AS line
        UNION ALL SELECT m.s2, (j.fault = 'truncated')::INTEGER, 'K', chr(10) || j.role || ':' || j.text FROM moves m
          WHERE m.s = ch.s2 AND m.ini = j.ini AND j.fault IN ('', 'truncated')
        UNION ALL SELECT m.s2, 2 + (j.fault = 'truncated')::INTEGER, 'R',
            chr(10) || CASE m.ini WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || j.text FROM moves m
          WHERE m.s = ch.s2 AND m.ini != 's' AND j.fault IN ('', 'truncated')) o))
  WHERE place = 1),
counts AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (following IS NOT NULL AND ini || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ends AS (
  SELECT dp.conv_id, dp.cost + ch.c AS cost, dp.audit || ch.letters AS audit, dp.lines || ch.added AS lines,
    row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + ch.c, dp.audit || ch.letters) AS place
  FROM dp JOIN counts ON counts.conv_id IS NOT DISTINCT FROM dp.conv_id AND counts.rows = dp.n JOIN chains ch ON ch.s = dp.s AND ch.s2 IN (0, 3)),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(substr(coalesce(lines, ''), 2)) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM ids.conv_id AND ends.place = 1
"""
