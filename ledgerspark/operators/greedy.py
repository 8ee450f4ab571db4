"""Greedy choices per key, computed from distinct values and running values over them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import RunningMin, RunningSum, chunk_bounds, chunk_number, with_running
from ledgerspark.session import stored


def _position(df: DataFrame, column: str) -> Column:
    """A date, time or whole number as a number."""
    kind, c = df.schema[column].dataType.simpleString(), F.col(column)
    if kind == "date":
        return F.unix_date(c).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        # day and time of day, apart from any time zone
        return F.unix_date(c.cast("date")).cast("bigint") * 86_400_000_000 + F.expr(
            f"CAST(extract(HOUR FROM `{column}`) * 3600 + extract(MINUTE FROM `{column}`) * 60 AS bigint) * 1000000 + CAST(extract(SECOND FROM `{column}`) * 1000000 AS bigint)"
        )
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")
    raise TypeError(f"{column} must be a date, a time or a whole number")


#: Ends of a key that are gone through in one list.
FEW = 1 << 16


def interval_schedule(df: DataFrame, keys: Sequence[str], start: str, end: str, *, chunks: int | None = None, few: int = FEW) -> DataFrame:
    """Per key, the fewest intervals to remove so that the rest do not overlap; touching is fine.

    Empty intervals (start = end) overlap nothing that starts or ends there and count. One that ends before it
    starts, or lacks an end, cannot be kept and is removed.

    After an interval that ends at L the next one kept is the first to end among those that start at L or
    later. Keys of up to ``few`` ends have them gone through in order, as one sorted list. Keys with more, or all with ``chunks``,
    are never held in one place, see ``_by_steps``.
    """
    spans = df.select(*keys, _position(df, start).alias("_s"), _position(df, end).alias("_e"))
    latest = F.max(F.expr("IF(_s < _e, _s, NULL)")).alias("_s")
    empty = F.count_if(F.col("_s") == F.col("_e")).alias("_z")
    # of an end: the latest start, how many are empty, and how many there are; no start and none empty where nothing can be kept
    ends = stored(spans.groupBy(*keys, "_e").agg(latest, empty, F.count(F.lit(1)).alias("_n")), "ends")
    if chunks is not None:
        return _by_steps(ends, keys, chunks)
    many = ends.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > few)
    if many.isEmpty():
        return _in_order(ends, keys)
    many = many.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [ends[k].eqNullSafe(many[f"_{k}"]) for k in keys], F.lit(True))
    rest = _by_steps(stored(ends.join(many, same, "left_semi"), "ends"), keys, None)
    return _in_order(ends.join(many, same, "left_anti"), keys).unionByName(rest) if keys else rest


def _in_order(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``removed`` of keys with few ends: the last end kept and how many are kept, carried over each key's sorted ends."""
    useful = F.when(F.col("_s").isNotNull() | (F.col("_z") > 0), F.struct("_e", "_s", "_z"))
    listed = ends.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sort_array(F.collect_list(useful)).alias("_ends"))

    def step(done: Column, x: Column) -> Column:
        own = F.coalesce((x["_s"] >= done["at"]).cast("bigint"), F.lit(0).cast("bigint")) + x["_z"]
        return F.struct(F.when(own > 0, x["_e"]).otherwise(done["at"]).alias("at"), (done["kept"] + own).alias("kept"))

    begin = F.struct(F.lit(-(2**63)).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("kept"))
    return listed.select(*keys, (F.col("_n") - F.aggregate("_ends", begin, step, lambda done: done["kept"])).alias("removed"))


def _by_steps(counted: DataFrame, keys: Sequence[str], chunks: int | None) -> DataFrame:
    """``removed`` of keys with any number of ends. Every end has a successor, which one running minimum over falling
    starts finds for all ends. The number kept is that of the steps from a key's first end on. Ranges of ends are
    followed to the first end outside, each in one task; the ends where ranges are entered are then joined to where they
    lead, twice as far in each round. No key is ever held in one place.
    """
    ends = counted.filter("_s IS NOT NULL OR _z > 0").drop("_n")

    def row(at: str, kind: int, own: str, reach: str | None) -> str:
        found = f"named_struct('e', _e, 'w', -({reach}))" if reach else "CAST(NULL AS struct<e: bigint, w: bigint>)"
        return f"named_struct('at', {at}, 'kind', {kind}, 'own', {own}, 'first', false, 'reach', {found})"

    # at one place: what starts there, then the question of what follows its end, then what is empty there
    rows = f"array({row('-_s', 0, '_e', '_z + 1')}, {row('-_e', 1, '_e', None)}, {row('-_e', 2, '_e', '_z')})"
    asked = ends.select(*keys, "_s", "_z", F.explode(F.expr(rows)).alias("r"))
    asked = asked.filter("(r.kind <> 0 OR _s IS NOT NULL) AND (r.kind <> 2 OR _z > 0)").select(*keys, "r.*")
    begin = "named_struct('at', 9223372036854775807L, 'kind', 1, 'own', 0L, 'first', true, 'reach', CAST(NULL AS struct<e: bigint, w: bigint>))"
    firsts = ends.select(*keys).distinct().select(*keys, F.expr(begin).alias("r")).select(*keys, "r.*")
    led = with_running(asked.unionByName(firsts), keys, ["at", "kind", "own"], chunks=chunks, to=RunningMin("reach"))
    steps = led.filter("kind = 1").select(
        *keys, (~F.col("first")).alias("later"), "own", F.col("to").isNotNull().alias("more"),
        F.coalesce("to.e", F.lit(0)).alias("next"), F.coalesce(-F.col("to.w"), F.lit(0)).alias("kept"),
    )
    place, steps = ["later", "own"], stored(steps, "steps")
    bounds = chunk_bounds(steps, [*keys, *place], chunks)
    ranged = steps.withColumn("_chunk", chunk_number(steps, [*keys, *place], bounds) if bounds else F.lit(0))

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(place, ignore_index=True)
        at = {own: i for i, (later, own) in enumerate(zip(part["later"], part["own"])) if later}
        more, to, kept = part["more"].tolist(), part["next"].tolist(), part["kept"].tolist()
        for i in range(len(part) - 1, -1, -1):  # a step always leads to a later end
            j = at.get(to[i]) if more[i] else None
            if j is not None:
                more[i], to[i], kept[i] = more[j], to[j], kept[i] + kept[j]
        return part.assign(more=more, next=to, kept=kept).drop(columns="_chunk")

    out = ranged.groupBy(*keys, "_chunk").applyInPandas(follow, steps.schema)
    total = _followed(out, keys) if bounds else out.filter("NOT later")
    both = counted.groupBy(*keys).agg(F.sum("_n").alias("n")).unionByName(total.select(*keys, (-F.col("kept")).alias("n")))
    return both.groupBy(*keys).agg(F.sum("n").alias("removed"))


def _followed(steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first steps of all keys, followed to the end: each round joins the ends that others lead to with theirs."""

    def named(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("own").alias("_own"), *[F.col(c).alias(f"_{c}") for c in ("more", "next", "kept")])

    def meets(left: DataFrame, right: DataFrame) -> Column:
        same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys], F.lit(True))
        return same & left["more"] & (left["next"] == right["_own"])

    now = stored(steps, "followed")
    led = now.filter("more").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("next").alias("_next")).distinct()
    entered = reduce(lambda a, b: a & b, [now[k].eqNullSafe(led[f"_{k}"]) for k in keys], now["own"] == led["_next"])
    now = stored(now.filter("NOT later").unionByName(now.filter("later").join(led, entered, "left_semi")), "followed")
    while not now.filter("NOT later AND more").isEmpty():
        then = named(now.filter("later"))
        joined = now.join(then, meets(now, then), "left")
        hit = F.col("_own").isNotNull()
        now = stored(
            joined.select(
                *keys, "later", "own", F.when(hit, F.col("_more")).otherwise(F.col("more")).alias("more"),
                F.when(hit, F.col("_next")).otherwise(F.col("next")).alias("next"), (F.col("kept") + F.coalesce("_kept", F.lit(0))).alias("kept"),
            ),
            "followed",
        )
    return now.filter("NOT later")


def greedy_assignment(
    requests: DataFrame, supplies: DataFrame, keys: Sequence[str], need: str, size: str, **kw
) -> DataFrame:
    """Per key, the most requests that can be met, each by one supply of at least its need.

    For a threshold t, requests above t can only use supplies above t; the largest shortfall over
    all thresholds is what must stay unmet. That takes counts per distinct value and running
    sums from the top, no matching of single rows.
    """
    r = requests.select(*keys, F.col(need).alias("_v"), F.lit(1).alias("_r"), F.lit(0).alias("_s"))
    s = supplies.select(*keys, F.col(size).alias("_v"), F.lit(0).alias("_r"), F.lit(1).alias("_s"))
    counted = r.unionAll(s).groupBy(*keys, "_v").agg(F.sum("_r").alias("_r"), F.sum("_s").alias("_s"))
    falling = counted.withColumn("_neg", -F.col("_v"))
    run = with_running(falling, keys, ["_neg"], _rs=RunningSum("_r"), _ss=RunningSum("_s"), **kw)
    short = run.withColumn("_short", F.col("_rs") - F.col("_ss"))
    return short.groupBy(*keys).agg(
        F.sum("_r").alias("requests"), (F.sum("_r") - F.greatest(F.max("_short"), F.lit(0))).alias("met")
    )
