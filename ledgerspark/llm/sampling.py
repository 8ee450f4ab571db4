"""Bounded samples that do not depend on partitions, and the size of ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a range whose running values are one task's.
SPLIT_ROWS = 1 << 16


def least_hashed(df: DataFrame, order: str, rows: int, n: int, *ties: str) -> DataFrame:
    """The ``n`` of ``rows`` rows with the least 64-bit hash in column ``order``.

    The part of the hash range that should hold twice as many goes to the sort, so that what the
    tasks send to it stays bounded however many there are. Few hashes in that part make the sample smaller.
    """
    share = min(1.0, (2 * n + 64) / max(1, rows))
    limit = (1 << 63) - 1 if share == 1.0 else -(1 << 63) + int(share * (1 << 64))
    return df.filter(F.col(order) <= limit).orderBy(order, *ties).limit(n)
