"""Snapshots in key buckets with a tree of digests, compared by the buckets that differ.

A snapshot is written once, by bucket of its key. Next to it stands a tree: a leaf per bucket has the number of
rows and two sums over the rows' hashes, which no order of rows changes; FANOUT nodes are summed to one of
the next level, up to a single root. Two snapshots are walked down from their roots, into the nodes that
differ; only the buckets found at the bottom are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import stored

FANOUT = 16
TREE = "level int, node int, n bigint, one decimal(38,0), two decimal(38,0)"
BUCKET = "key_bucket"


def row_hash(columns: list[str], seed: int) -> Column:
    """64-bit hash of a row in which a null differs from every value and from a null elsewhere."""
    parts = [F.lit(seed)]
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


class Snapshot:
    """A table under ``path`` in ``buckets`` directories by ``key``, with its tree; null is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 4096):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def write(self, df: DataFrame) -> Snapshot:
        """Write the rows, and then the tree, from which a snapshot counts as there."""
        bucket = F.pmod(F.xxhash64(F.col(self.key).isNull(), self.key), F.lit(self.buckets)).cast("int")
        rows = df.select(*sorted(df.columns), bucket.alias(BUCKET))
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/rows")
        layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        self.spark.createDataFrame([(layout,)], "layout string").coalesce(1).write.parquet(f"{self.path}/layout")
        kept = self.spark.read.schema(rows.schema).parquet(f"{self.path}/rows")
        sums = [F.sum(row_hash(sorted(df.columns), s).cast("decimal(38,0)")).alias(n) for n, s in (("one", 1), ("two", 2))]
        level = kept.groupBy(F.col(BUCKET).alias("node")).agg(F.count(F.lit(1)).alias("n"), *sums)
        level = tree = stored(level.withColumn("level", F.lit(0)).select("level", "node", "n", "one", "two"), "digests")
        size, height = self.buckets, 0
        while size > 1:
            size, height = -(-size // FANOUT), height + 1
            above = F.expr(f"CAST(node DIV {FANOUT} AS int)").alias("node")
            level = level.groupBy(above).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("one", "two")])
            level = level.withColumn("level", F.lit(height)).select("level", "node", "n", "one", "two")
            tree = tree.unionByName(level)
        tree.repartition("level").write.partitionBy("level").parquet(f"{self.path}/tree")
        return self

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if named: their directories are the only ones opened."""
        layout = self.spark.read.schema("layout string").parquet(f"{self.path}/layout").first()[0]
        rows = self.spark.read.schema(layout).parquet(f"{self.path}/rows")
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        return rows.drop(BUCKET)

    def level(self, level: int) -> DataFrame:
        return self.spark.read.schema(TREE).parquet(f"{self.path}/tree").filter(F.col("level") == level).drop("level")


def differing_buckets(one: Snapshot, other: Snapshot) -> list[int]:
    """Buckets whose rows differ, ascending; at most all buckets, numbers only. Each level of the trees is read for
    the children of the nodes that differed above."""
    if (one.key, one.buckets) != (other.key, other.buckets):
        raise ValueError("snapshots differ in key or number of buckets")
    sizes = [one.buckets]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FANOUT))
    nodes = [0]
    for level in range(len(sizes) - 1, -1, -1):
        sides = []
        for s, name in ((one, "a"), (other, "b")):
            kept = s.level(level).filter(F.col("node").isin(nodes))
            sides.append(kept.select("node", F.struct("n", "one", "two").alias(name)))
        met = sides[0].join(sides[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        nodes = sorted(r.node for r in met.select("node").collect())
        if not nodes:
            return []
        if level:
            nodes = [c for n in nodes for c in range(n * FANOUT, min((n + 1) * FANOUT, sizes[level - 1]))]
    return nodes


def compared(new: Snapshot, old: Snapshot, compare: Callable[[DataFrame, DataFrame, str], DataFrame]) -> DataFrame:
    """``compare(new, old, key)`` over the buckets that differ. For comparisons that give nothing for equal rows,
    such as the changes of a sync, that is the comparison of the whole."""
    buckets = differing_buckets(new, old)
    return compare(new.read(buckets), old.read(buckets), new.key)
