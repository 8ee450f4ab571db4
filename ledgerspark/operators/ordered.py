"""Running values over ordered groups, for groups of any size.

A window over ``partitionBy(keys).orderBy(order)`` puts a whole group into one task. Here the range of
(keys, order) is cut into as many chunks as the rows need, CHUNK_ROWS to a chunk, at quantiles of a small
sample. The bounds are literals, and a row finds its chunk by binary search among them, so every reader sees
the same chunks and nothing is written. Each chunk computes its own running values; one summary row
per (keys, chunk) is combined across chunks, and what earlier chunks carry into a chunk is joined
back. A chunk continues at most the one group that its predecessor ended with, so the carry table has
fewer rows than there are chunks. Rows that fit one chunk need neither summary nor join.

``order`` names ascending columns that are unique within a group. ``df`` must give the same rows each time it is
read, as it is read for its count, the sample, the summary and the result; what is costly to make should
be written first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a chunk, and sampled positions for each chunk.
CHUNK_ROWS, SAMPLES = 1 << 20, 32


@dataclass(frozen=True)
class RowNumber:
    def local(self, w: WindowSpec) -> Column:
        return F.row_number().over(w).cast("bigint")

    def summary(self, order: Column) -> Column:
        return F.count(F.lit(1))

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.sum(name).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        return local + F.coalesce(carry, F.lit(0))

    def result(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class RunningSum:
    """Sum of all rows so far, nulls counted as 0."""

    col: str

    def local(self, w: WindowSpec) -> Column:
        return F.coalesce(F.sum(self.col).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))

    def summary(self, order: Column) -> Column:
        return F.coalesce(F.sum(self.col), F.lit(0))

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.sum(name).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        return local + F.coalesce(carry, F.lit(0))

    def result(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class RunningMax:
    col: str

    def local(self, w: WindowSpec) -> Column:
        return F.max(self.col).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, order: Column) -> Column:
        return F.max(self.col)

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.max(name).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        return F.greatest(local, carry)

    def result(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class RunningMin(RunningMax):
    def local(self, w: WindowSpec) -> Column:
        return F.min(self.col).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, order: Column) -> Column:
        return F.min(self.col)

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.min(name).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        # of structs, which least() does not take
        return F.array_min(F.filter(F.array(local, carry), lambda v: v.isNotNull()))


@dataclass(frozen=True)
class LastNonNull:
    col: str

    def local(self, w: WindowSpec) -> Column:
        return F.last(self.col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, order: Column) -> Column:
        return F.max_by(F.col(self.col), F.when(F.col(self.col).isNotNull(), order))

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.last(name, ignorenulls=True).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        return F.coalesce(local, carry)

    def result(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class Previous:
    """Value of the row before; null on the first row of a group."""

    col: str

    def local(self, w: WindowSpec) -> Column:
        return F.lag(F.struct(F.col(self.col).alias("v"))).over(w)

    def summary(self, order: Column) -> Column:
        return F.max_by(F.struct(F.col(self.col).alias("v")), order)

    def carry(self, name: str, w: WindowSpec) -> Column:
        return F.last(name).over(w)

    def merge(self, local: Column, carry: Column) -> Column:
        return F.coalesce(local, carry)

    def result(self, merged: Column) -> Column:
        return merged["v"]


def chunk_bounds(df: DataFrame, columns: Sequence[str], chunks: int | None = None, chunk_rows: int = CHUNK_ROWS) -> list[tuple]:
    """Upper bounds of all chunks but the last, ascending: SAMPLES positions a chunk are sampled and sorted.

    By default ``chunk_rows`` rows make a chunk, and there are no more chunks than shuffle partitions.
    """
    if chunks == 1:
        return []
    n = df.count()
    if chunks is None:
        chunks = min(-(-n // chunk_rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if chunks < 2 or not n:
        return []
    share = min(1.0, SAMPLES * chunks / n)
    sampled = [tuple(r) for r in df.select(*columns).sample(share, seed=5).orderBy(*columns).collect()]
    cuts = [sampled[len(sampled) * i // chunks] for i in range(1, chunks)] if sampled else []
    return list(dict.fromkeys(cuts))


def chunk_number(df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """How many of the bounds lie before a row's position: a binary search as an expression."""
    kinds = [df.schema[c].dataType for c in columns]
    position = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])

    def literal(bound: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(k).alias(f"c{i}") for i, (v, k) in enumerate(zip(bound, kinds))])

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(position <= literal(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(bounds))


def with_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, chunks: int | None = None, chunk_rows: int = CHUNK_ROWS, **ops
) -> DataFrame:
    """``df`` plus one column per running value in ``ops``, all in one pass; ``chunks`` and ``chunk_rows`` as in ``chunk_bounds``."""
    bounds = chunk_bounds(df, [*keys, *order], chunks, chunk_rows)
    if not bounds:
        w = Window.partitionBy(*keys).orderBy(*order)
        local = df.withColumns({f"_local_{n}": op.local(w) for n, op in ops.items()})
        return local.select(*df.columns, *[op.result(F.col(f"_local_{n}")).alias(n) for n, op in ops.items()])
    ranged = df.withColumn("_chunk", chunk_number(df, [*keys, *order], bounds))
    position = F.struct(*[F.col(c) for c in order])
    summary = ranged.groupBy(*keys, "_chunk").agg(*[op.summary(position).alias(n) for n, op in ops.items()])
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")  # a row per chunk
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("_chunk").alias("_at"),
            *[op.carry(n, earlier).alias(f"_carry_{n}") for n, op in ops.items()],
            F.row_number().over(by_chunk).alias("_nth"),
        )
        .filter("_nth > 1")
        .drop("_nth")
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    local = ranged.withColumns({f"_local_{n}": op.local(w) for n, op in ops.items()})
    on = F.col("_chunk") == F.col("_at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return local.join(carried, on, "left").select(
        *df.columns,
        *[op.result(op.merge(F.col(f"_local_{n}"), F.col(f"_carry_{n}"))).alias(n) for n, op in ops.items()],
    )
