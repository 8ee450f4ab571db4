"""Everything that can be reached over a stored link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.session import new_path, stored


def _bucket(node: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int").alias("bucket")


def write_links(links: DataFrame, path: str, buckets: int) -> DataFrame:
    """Links (src, dst) in directories by bucket of their source, sorted by it; a bucket with many links has several files."""
    rows = links.select("src", "dst", _bucket("src", buckets))
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "src").write.partitionBy("bucket").parquet(path)
    return links.sparkSession.read.schema(rows.schema).parquet(path)


def link_frontier(links: DataFrame, seeds: DataFrame, buckets: int | None = None) -> DataFrame:
    """Nodes reachable from ``seeds`` (column node) over ``links`` (src, dst), seeds included, with
    the round that found them. Null is no node.

    Links and the nodes seen lie in directories by bucket. A round opens the links of the buckets that its
    frontier is in, and the seen nodes of the buckets that it leads to; a frontier of a few nodes therefore
    reads a few buckets, however many links there are. Each round is written to the shared folder, which cuts
    the lineage and survives lost executors. Rounds go on until one finds nothing; every node is expanded once.
    There are as many buckets as shuffle partitions, if not named.
    """
    spark = links.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = write_links(links.filter("src IS NOT NULL AND dst IS NOT NULL"), new_path(spark, "links"), buckets)
    path = new_path(spark, "frontier")
    found = seeds.filter("node IS NOT NULL").select("node").distinct()
    kind = found.schema["node"].dataType.simpleString()
    number = 0
    while True:
        found.select("node", _bucket("node", buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/round={number}")
        seen = spark.read.option("basePath", path).schema(f"node {kind}, round int, bucket int").parquet(f"{path}/round=*")
        newest = spark.read.schema(f"node {kind}, bucket int").parquet(f"{path}/round={number}")
        near = _buckets(newest)
        if not near:
            return seen.select("node", "round")
        touched = edges.filter(F.col("bucket").isin(near)).join(newest.select(F.col("node").alias("src")), "src")
        led = stored(touched.select(F.col("dst").alias("node")).distinct().select("node", _bucket("node", buckets)), "led")
        known = seen.filter(F.col("bucket").isin(_buckets(led))).select("node")
        found = led.join(known, "node", "left_anti").select("node")
        number += 1


def _buckets(nodes: DataFrame) -> list[int]:
    """At most as many numbers as there are buckets."""
    return [r.bucket for r in nodes.select("bucket").distinct().collect()]
