"""Aggregations that stay partial (map-side combined) whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import RowNumber, with_running


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Words of all lines, separated by single blanks; empty tokens are no words."""
    words = df.select(F.explode(F.split(text, "[ \r\n]")).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def flow_sum(lines: DataFrame, line: str = "value") -> DataFrame:
    """Traffic per phone of tab-separated lines: phone second, up third from last, down second from last."""
    f = F.split(line, "\t")
    parsed = lines.select(
        F.get(f, F.lit(1)).alias("phone"),
        F.try_element_at(f, F.lit(-3)).cast("bigint").alias("up"),
        F.try_element_at(f, F.lit(-2)).cast("bigint").alias("down"),
    )
    return parsed.groupBy("phone").agg(
        F.sum("up").alias("up"), F.sum("down").alias("down"), F.sum(F.col("up") + F.col("down")).alias("total")
    )


def from_small_domain(df: DataFrame, column: str, most: int) -> Column:
    """The column, after a check that it has at most ``most`` distinct values: lists of them are bounded then."""
    found = df.select(column).distinct().agg(F.count(F.lit(1))).scalar()
    error = F.concat(F.lit(f"{column} has more than {most} values: "), found.cast("string"))
    return F.when(found <= most, F.col(column)).otherwise(F.raise_error(error).cast(df.schema[column].dataType))


def groups_without(df: DataFrame, key: str, matching: Column, listed: str, most: int = 1000) -> DataFrame:
    """Groups in which no row matches, in one scan: row count and the distinct values of ``listed``.

    ``listed`` must come from a small domain such as a status code; more than ``most`` values are an error.
    """
    return (
        df.groupBy(key)
        .agg(
            F.sum(F.when(matching, 1).otherwise(0)).alias("_hits"),
            F.concat_ws(",", F.sort_array(F.collect_set(from_small_domain(df, listed, most)))).alias("listed"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(f"_hits < 1 AND {key} IS NOT NULL")
        .drop("_hits")
    )


def string_join(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, sep: str = ",", *, per_row: int, **kw
) -> DataFrame:
    """Join the non-null values of a key in order.

    The result of a hot key has no size bound, so it comes as numbered parts of ``per_row``
    values; the parts of a key in order, joined by ``sep``, are the whole string.
    """
    numbered = with_running(df.filter(F.col(value).isNotNull()), keys, order, _rn=RowNumber(), **kw)
    part = F.floor((F.col("_rn") - 1) / per_row)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", value))), lambda s: s[value]), sep)
    return numbered.groupBy(*keys, part.alias("part")).agg(joined.alias("joined"))


def average_without_extremes(df: DataFrame, group: str, value: str) -> DataFrame:
    """Average per group after dropping every row at the group's highest and lowest value.

    Rows are counted per distinct value first; the second step reads the two extremes and their
    counts with ``max_by`` and ``min_by``, so no group is sorted.
    """
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy(group).agg(
        F.sum(F.col(value) * F.col("_n")).alias("_sum"),
        F.sum("_n").alias("_rows"),
        F.min(value).alias("_lo"),
        F.max(value).alias("_hi"),
        F.min_by("_n", value).alias("_lo_n"),
        F.max_by("_n", value).alias("_hi_n"),
    )
    inner_sum = F.col("_sum") - F.col("_lo") * F.col("_lo_n") - F.col("_hi") * F.col("_hi_n")
    inner_rows = F.col("_rows") - F.col("_lo_n") - F.col("_hi_n")
    return totals.filter((F.col("_lo") < F.col("_hi")) & (inner_rows > 0)).select(
        group, (inner_sum / inner_rows).alias("average"), inner_rows.alias("rows_used")
    )


def keep_groups_with(df: DataFrame, key: str, matching: Column) -> DataFrame:
    """Rows of groups in which at least one row matches: a windowed ``sum(flag) > 0`` without
    bringing a group together. Null is a group like any other."""
    wanted = df.filter(matching).select(F.col(key).alias("_wanted")).distinct()
    return df.join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")


def price_rises(daily: DataFrame, keys: Sequence[str], day: str, price: str) -> DataFrame:
    """Best total profit with any number of buys and sells; ``daily`` holds one row per (keys, day),
    so a group is no longer than the calendar."""
    step = F.lead(price).over(Window.partitionBy(*keys).orderBy(day)) - F.col(price)
    return daily.withColumn("_step", step).groupBy(*keys).agg(
        F.coalesce(F.sum(F.greatest("_step", F.lit(0))), F.lit(0)).cast("bigint").alias("profit")
    )
