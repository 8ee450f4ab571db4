"""Digest trees of snapshots: what they find, and what is read."""

import glob

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import sync
from ledgerspark.sources import digests
from ledgerspark.sources.digests import Snapshot, compared, differing_buckets


@pytest.fixture
def snapshot(spark, tmp_path):
    def write(name, df, buckets=64):
        return Snapshot(spark, str(tmp_path / name), "k", buckets).write(df)

    return write


def bucket_of(spark, key, buckets):
    k = F.lit(key).cast("bigint")
    return spark.range(1).select(F.pmod(F.xxhash64(k.isNull(), k), F.lit(buckets))).first()[0]


def test_one_changed_row_of_a_million_reads_one_bucket(spark, snapshot):
    rows = spark.range(1_000_000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("v"))
    old = snapshot("old", rows, 256)
    new = snapshot("new", rows.withColumn("v", F.when(F.col("k") == 424242, -1).otherwise(F.col("v"))), 256)
    here = bucket_of(spark, 424242, 256)
    assert differing_buckets(new, old) == [here]
    # no other bucket can be opened
    for s in (old, new):
        for path in glob.glob(f"{s.path}/rows/key_bucket=*/*.parquet"):
            if f"key_bucket={here}/" not in path:
                open(path, "wb").write(b"no parquet file")
    found = compared(new, old, sync.sync_by_key).collect()
    assert [(r.k, r.change, r.source.v) for r in found] == [(424242, "update", -1)]


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_changes_are_those_of_the_whole(spark, snapshot, buckets):
    """Inserts, deletes, updates, nulls as keys and values, values that move between columns, and rows that are alike."""
    base = [(i, i % 3, f"s{i % 5}") for i in range(60)] + [(None, 1, None)]
    old = spark.createDataFrame(base, "k long, v int, s string")
    changed = [r for r in base if r[0] not in (7, 8)] + [(100, None, None), (101, 1, None)]
    changed = [(r[0], None, "moved") if r[0] == 11 else (None, None, "x") if r[0] is None else r for r in changed]
    new = spark.createDataFrame(changed, "k long, v int, s string")
    a, b = snapshot("new", new, buckets), snapshot("old", old, buckets)
    for compare in (sync.sync_by_key, lambda n, o, k: sync.snapshot_diff(o, n, k).filter("flag = 1")):
        got, want = compared(a, b, compare), compare(new.select("k", "s", "v"), old.select("k", "s", "v"), "k")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert differing_buckets(a, a) == []


def test_empty_and_equal_snapshots(spark, snapshot):
    rows = spark.createDataFrame([(i, None) for i in range(9)], "k long, v string")
    full, same, none = snapshot("full", rows), snapshot("same", rows.orderBy(F.desc("k"))), snapshot("none", rows.limit(0))
    assert differing_buckets(full, same) == [] == differing_buckets(none, none)
    assert differing_buckets(full, none) == sorted({bucket_of(spark, i, 64) for i in range(9)})
    with pytest.raises(ValueError, match="number of buckets"):
        differing_buckets(full, snapshot("other", rows, 8))


def test_hashes_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1), (0, 1)], "a int, b int")
    assert df.select(digests.row_hash(["a", "b"], 1).alias("h")).distinct().count() == 5
