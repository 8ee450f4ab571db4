"""One row per key, checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """``columns`` of each key as the struct ``name``, with the keys as ``{name}_{key}``; a repeated
    key is an error. Null is a key like any other.

    Copies of a key are counted before the shuffle, so a key that is repeated often does not
    gather in one task before it is found.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*columns)).alias(name))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    unique = F.when(F.col("_n") == 1, F.col(name)).otherwise(
        F.raise_error(F.concat(F.lit(f"key is not unique in {name}: "), shown))
    )
    return grouped.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], unique.alias(name))
