"""Ranks, runs and running merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import LastNonNull, RowNumber, with_running


def dense_rank_desc(df: DataFrame, value: str, **kw) -> DataFrame:
    """Dense rank over the whole table, highest value first.

    Only the distinct values are ranked, and they are split over tasks when there are many. A null
    has no rank.
    """
    values = df.filter(F.col(value).isNotNull()).select(value).distinct().withColumn("_neg", -F.col(value))
    ranks = with_running(values, [], ["_neg"], rank=RowNumber(), **kw).drop("_neg")
    return df.join(ranks, value, "left")


def consecutive_values(df: DataFrame, keys: Sequence[str], order: str, value: str, times: int, **kw) -> DataFrame:
    """Values that occur at least ``times`` times in a row within a key.

    Row number within the key less row number within (key, value) is constant along a run.
    """
    numbered = with_running(df.select(*keys, order, value), keys, [order], _all=RowNumber(), **kw)
    numbered = with_running(numbered, [*keys, value], [order], _same=RowNumber(), **kw)
    runs = numbered.groupBy(*keys, value, (F.col("_all") - F.col("_same")).alias("_run")).count()
    return runs.filter(F.col("count") >= times).select(*keys, value).distinct()


def longest_streak(df: DataFrame, user: str, day: str) -> DataFrame:
    """Longest run of consecutive days per user. Days are made distinct first: a user's group is
    then no longer than the calendar, however many rows the user has."""
    days = df.select(user, day).distinct()
    rn = F.row_number().over(Window.partitionBy(user).orderBy(day))
    runs = days.withColumn("_run", F.date_sub(day, rn)).groupBy(user, "_run").count()
    return runs.groupBy(user).agg(F.max("count").alias("streak"))


def merge_last_non_null(df: DataFrame, struct: str, keys: Sequence[str], order: Sequence[str], **kw) -> DataFrame:
    """Running merge of a struct column: each field keeps its last non-null value so far."""
    fields = df.schema[struct].dataType.names
    flat = df.select(*[c for c in df.columns if c != struct], *[F.col(f"{struct}.{f}").alias(f"_in_{f}") for f in fields])
    merged = with_running(flat, keys, order, **{f"_out_{f}": LastNonNull(f"_in_{f}") for f in fields}, **kw)
    return merged.select(
        *[c for c in df.columns if c != struct], F.struct(*[F.col(f"_out_{f}").alias(f) for f in fields]).alias(struct)
    )
