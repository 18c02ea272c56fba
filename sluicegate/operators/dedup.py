"""Exact removal of repeats by the four-column key; a null device equals a null device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.constants import DEDUP_KEY, DEDUP_TTL_MS
from sluicegate.sources.tables import stage

#: Rows of a key that one task follows through time at once, see :func:`dedup_ttl`.
FEW_ROWS = 200


def dedup_first_seen(
    events: DataFrame, arrival: str | tuple[str, ...] = "arrival", key: tuple[str, ...] = DEDUP_KEY
) -> DataFrame:
    """Keep the first arrival of every key; ``arrival`` may be several columns, as in time, partition, offset.

    The rank limit is applied before the shuffle as well (``WindowGroupLimit``), so a key
    repeated a billion times leaves each map task as one row.
    """
    order = (arrival,) if isinstance(arrival, str) else arrival
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return events.withColumn("_nth", first).where(F.col("_nth") == 1).drop("_nth")


def dedup_ttl(
    events: DataFrame,
    arrived_at: str = "arrived_at",
    arrival: str = "arrival",
    key: tuple[str, ...] = DEDUP_KEY,
    ttl_ms: int = DEDUP_TTL_MS,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Keep a row unless the same key was kept less than ``ttl_ms`` before.

    Only kept rows start a new period, so the choice is a chain along each key. Most keys have few rows, and one task follows
    the chain of such a key through its sorted rows. Of keys with more than ``few_rows``, those whose last arrival comes less
    than one period after the first keep the first row only. Of the others, repeats in the same millisecond fall away before
    the shuffle. Every instant is then linked with its successor, the first instant of its key at least a period later, and the chains are marked by
    pointer doubling: as many joins as twice the logarithm of the longest chain, whatever the number of repeats.
    All of it is dealt out by key and time, so one steady key spreads over all tasks.
    """
    timed = events.withColumn("_at", F.unix_millis(arrived_at))
    spans = timed.groupBy(*key).agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.count(F.lit(1)).alias("_rows"))
    # Written out first, so that joining with the usual handful of keys needs no shuffle of the events.
    frequent = stage(spans.where(F.col("_rows") > few_rows), "frequent-keys")
    kept_of_few = followed(join_on(timed, frequent, key, "left_anti"), arrival, key, ttl_ms).select(*events.columns)
    if frequent.isEmpty():
        return kept_of_few
    is_long = F.coalesce(F.col("_to") - F.col("_from") >= ttl_ms, F.lit(False))
    long_keys = stage(frequent.where(is_long).select(*key, F.monotonically_increasing_id().alias("_key")), "long-keys")
    short = dedup_first_seen(join_on(timed, frequent.where(~is_long), key, "left_semi"), ("_at", arrival), key)
    of_long = join_on(timed, long_keys, key, "inner", "_key")
    instants = stage(dedup_first_seen(of_long, arrival, ("_key", "_at")), "instants")
    kept = chains(stage(successors(instants, ttl_ms), "successors"))
    of_frequent = short.select(*events.columns).unionByName(instants.join(kept, ["_key", "_at"]).select(*events.columns))
    return kept_of_few.unionByName(of_frequent)


def followed(timed: DataFrame, arrival: str, key: tuple[str, ...], ttl_ms: int) -> DataFrame:
    """The kept rows of keys with few rows each: a key's rows in order of time and arrival, gone through once.

    A row without time counts, as the first, only where its key has no two rows a period apart.
    """
    rest = [name for name in timed.columns if name not in (*key, arrival)]
    row = F.struct("_at", F.col(arrival).alias("_order"), F.struct(*rest).alias("_rest"))

    def ordered(a: Column, b: Column) -> Column:
        earlier = lambda x, y: x.isNull() & y.isNotNull() | (x < y)
        for name in ("_order", "_at"):
            less, more = (F.coalesce(earlier(x[name], y[name]), F.lit(False)) for x, y in ((a, b), (b, a)))
            rest_of = F.lit(0) if name == "_order" else by_order
            by_order = F.when(less, -1).when(more, 1).otherwise(rest_of)
        return by_order

    def step(kept: Column, one: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)["_at"]
        return F.when(F.coalesce(one["_at"] - last >= ttl_ms, F.size(kept) == 0), F.concat(kept, F.array(one))).otherwise(kept)

    rows = timed.groupBy(*key).agg(F.collect_list(row).alias("_rows"), (F.max("_at") - F.min("_at")).alias("_span"))
    in_order = rows.withColumn("_rows", F.array_sort("_rows", ordered))
    timely = F.filter("_rows", lambda one: one["_at"].isNotNull())
    chain = F.aggregate(timely, F.slice("_rows", 1, 0), step)
    kept = F.when(F.col("_span") >= ttl_ms, chain).otherwise(F.slice("_rows", 1, 1))
    opened = in_order.select(*key, F.explode(kept).alias("_row"))
    return opened.select(*key, F.col("_row._order").alias(arrival), *(F.col("_row._rest")[name].alias(name) for name in rest))


def successors(instants: DataFrame, ttl_ms: int) -> DataFrame:
    """``_key, _at, _next``: the first instant at least a period later; and rows with ``_first`` for instants after a pause.

    Time is cut into periods. Each instant stands in its own period's unit and in the one before, and asks in the unit after its
    own, so a unit holds two periods of a key, which have at most as many instants as milliseconds. Where it finds nothing
    there, the next instant follows a pause of a period and begins a chain itself. The nearest instant before or after a row
    is the last one met in time order, forwards or backwards, so a unit is passed once each way.
    """
    at = F.col("_at")
    own = F.call_function("div", at, F.lit(ttl_ms)) - F.when((at < 0) & (at % ttl_ms != 0), 1).otherwise(0)
    none = F.lit(None).cast("bigint")

    def row(unit: Column, asks: int, time: Column, instant: Column) -> Column:
        return F.struct(unit.alias("_unit"), F.lit(asks).alias("_asks"), time.alias("_time"), instant.alias("_instant"))

    rows = F.array(row(own - 1, 0, at, at), row(own, 0, at, at), row(own + 1, 1, at + ttl_ms, none))
    placed = instants.select("_key", at, own.alias("_own"), F.explode(rows).alias("_row")).select("_key", "_at", "_own", "_row.*")
    unit = Window.partitionBy("_key", "_unit")
    so_far = unit.orderBy(F.desc("_time"), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    earlier = unit.orderBy("_time", "_asks").rowsBetween(Window.unboundedPreceding, -1)
    met = placed.withColumns(
        {"_next": F.last("_instant", ignorenulls=True).over(so_far), "_before": F.last("_instant", ignorenulls=True).over(earlier)}
    )
    first = (F.col("_asks") == 0) & (F.col("_unit") < F.col("_own")) & F.coalesce(at - F.col("_before") >= ttl_ms, F.lit(True))
    asked = (F.col("_asks") == 1) & F.col("_next").isNotNull()
    return met.where(first | asked).select("_key", "_at", F.when(F.col("_asks") == 1, F.col("_next")).alias("_next"), first.alias("_first"))


def chains(links: DataFrame) -> DataFrame:
    """``_key, _at`` of all instants that successors lead to from the first ones.

    The jumps of length 1, 2, 4, ... are joined from each other until none is left. Chains often run into one another,
    so each table of jumps keeps only its starts that a jump of the length before leads to. Then the marked set grows from the
    longest jump to the shortest.
    """
    first = links.where("_first").select("_key", "_at")
    jumps = [stage(links.where("_next IS NOT NULL").select("_key", "_at", "_next"), "jumps")]
    while not jumps[-1].isEmpty():
        last = jumps[-1]
        ends = last.select("_key", F.col("_next").alias("_at")).distinct().unionByName(first)
        again = last.select("_key", F.col("_at").alias("_next"), F.col("_next").alias("_end"))
        twice = last.join(ends.distinct(), ["_key", "_at"], "left_semi").join(again, ["_key", "_next"])
        jumps.append(stage(twice.select("_key", "_at", F.col("_end").alias("_next")), "jumps"))
    marked = first
    for jump in reversed(jumps):
        ahead = marked.join(jump, ["_key", "_at"]).select("_key", F.col("_next").alias("_at"))
        marked = stage(marked.unionByName(ahead), "marked")
    return marked.distinct()


def join_on(left: DataFrame, right: DataFrame, columns: tuple[str, ...], how: str, *added: str) -> DataFrame:
    """Join on columns where null equals null, keeping the left side's columns and those named."""
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in columns]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *added)
