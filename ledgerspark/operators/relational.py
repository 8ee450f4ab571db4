"""Joins and filters whose meaning or plan needs more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """SQL ``key NOT IN (SELECT right_key ...)`` with its null rules, as a shuffled anti join.

    Spark plans the literal form as a join that broadcasts the whole right side. Here the rules
    become two one-row subqueries: a null on the right empties the result, and a null on the
    left survives only when the right side is empty.
    """
    values = right.select(F.col(right_key).alias("_value"))
    has_rows = values.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    has_null = values.filter("_value IS NULL").limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    candidates = left.filter(~has_null & (F.col(key).isNotNull() | ~has_rows))
    return candidates.join(values.filter("_value IS NOT NULL"), F.col(key) == F.col("_value"), "left_anti")


def top1_with_ties(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows that hold the largest value of their group, ties kept.

    The maximum is partially aggregated, so a hot group never meets in one task; the semi join
    against one row per group is broadcast or skew-split by AQE from run-time sizes.
    """
    best = df.groupBy(F.col(group).alias("_g")).agg(F.max(value).alias("_best"))
    return df.join(best, (F.col(group) == F.col("_g")) & (F.col(value) == F.col("_best")), "left_semi")


def any_column_differs(source: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Source rows that are new or differ, null-safe, from the existing row of the same key."""
    other = existing.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in source.columns if c != key])
    differs: Column = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in source.columns if c != key]
    )
    return (
        source.join(other, F.col(key) == F.col("_k"), "left")
        .filter(F.col("_k").isNull() | differs)
        .select(*source.columns)
    )


def rises_from_day_before(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Rows whose value is above that of the day before; ``df`` holds one row per (keys, day).

    ``datediff = 1`` is written as an equality on the shifted date, which Spark can hash.
    """
    before = df.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.date_add(day, 1).alias("_next"),
        F.col(value).alias("previous_value"),
    )
    on = F.col(day) == F.col("_next")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return df.join(before, on).filter(F.col(value) > F.col("previous_value")).select(*df.columns, "previous_value")


def swap_adjacent(df: DataFrame, seat: str) -> DataFrame:
    """Swap seats 1-2, 3-4, ...; a last odd seat stays. Seats are numbered from 1 without gaps.

    Only the seat count is needed, as a one-row subquery: the rows are not shuffled.
    """
    seats = df.agg(F.count(F.lit(1))).scalar()
    s = F.col(seat)
    moved = F.when(s % 2 == 0, s - 1).when(s == seats, s).otherwise(s + 1)
    return df.withColumn(seat, moved)


def second_highest(df: DataFrame, value: str) -> DataFrame:
    """The second distinct value from the top in one row, null when there is none."""
    top = df.agg(F.max(value)).scalar()
    return df.filter(F.col(value) < top).agg(F.max(value).alias("second_highest"))
