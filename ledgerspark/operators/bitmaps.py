"""Exact distinct counts from bitmaps that are kept by day and merged over any days.

A value is a bit at a position of a numbered bitmap of 32,768 bits, so values that lie close together share
bitmaps: dense ids cost an eighth of a byte, an id far from all others 4 KB. A day's bitmaps are made once from its
rows; the count of any days is that of their bitmaps put together, and no row is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.versions import VersionedTable


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, bucket and bitmap of the distinct values, a whole number; null is no value. Tasks build bitmaps before they shuffle."""
    present = df.filter(F.col(value).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(value).cast("bigint")).alias("bucket")
    return present.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(value).cast("bigint"))).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct values per key, over all bitmaps of the key."""
    return merged_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))


class DistinctByDay:
    """Bitmaps of the distinct values per key, kept by day."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], value: str, day: str = "date"):
        self.keys, self.value, self.day = list(keys), value, day
        self.table = VersionedTable(spark, path, day)

    def load(self, rows: DataFrame) -> None:
        """Make the bitmaps of the days that ``rows`` holds, whole days, in place of those there are."""
        days = [r[0] for r in rows.select(self.day).distinct().collect()]
        self.table.replace_partitions(distinct_bitmaps(rows, [self.day, *self.keys], self.value), days)

    def counts(self, first: str, last: str, name: str = "n") -> DataFrame:
        """Distinct values per key from day ``first`` to ``last``, from the bitmaps of those days."""
        day: Column = F.col(self.day)
        kept = self.table.read().filter((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))
        return distinct_counts(kept, self.keys, name)
