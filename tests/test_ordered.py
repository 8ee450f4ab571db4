import datetime
import os

from pyspark.sql import functions as F

from ledgerspark.operators.ordered import (
    LastNonNull,
    Previous,
    RowNumber,
    RunningMax,
    RunningSum,
    chunk_bounds,
    chunk_number,
    with_running,
)


def test_split_groups_equal_plain_windows(spark):
    """A third of the rows in one key; the split path must equal the one-window path."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"),
        F.hash("id").alias("o"),
        "id",
        F.when(F.col("id") % 5 == 0, F.col("id") % 17).alias("v"),
    )
    ops = dict(rn=RowNumber(), s=RunningSum("v"), m=RunningMax("v"), last=LastNonNull("v"), prev=Previous("v"))
    for keys in (["k"], []):
        plain = with_running(df, keys, ["o", "id"], chunks=1, **ops).collect()
        split = with_running(df, keys, ["o", "id"], chunks=23, **ops).collect()
        assert sorted(map(str, plain)) == sorted(map(str, split))
        assert len(split) == 3000


def test_null_keys_are_one_group(spark):
    df = spark.range(500).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("o"))
    rows = with_running(df, ["k"], ["o"], chunks=9, rn=RowNumber()).collect()
    assert sorted(r.rn for r in rows) == list(range(1, 501))


def test_chunks_are_even_and_follow_the_order(spark):
    """Bounds over text, timestamps, dates, binary and nulls; chunk numbers rise with the position, and no chunk is large."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("é"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 11 > 0, F.timestamp_seconds(F.col("id") * 977 % 100000)).alias("t"),
        F.lit(datetime.date(2024, 5, 1)).alias("d"),
        F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("b"),
        (F.col("id") % 5 == 0).alias("flag"),
        "id",
    )
    for columns in (["k", "t", "id"], ["id"], ["d", "b"], ["flag", "k", "b"], ["t", "id"]):
        bounds = chunk_bounds(df, columns, 16)
        assert 12 <= len(bounds) < 16
        rows = df.withColumn("c", chunk_number(df, columns, bounds)).orderBy(*columns).collect()
        numbers = [r.c for r in rows]
        assert numbers == sorted(numbers) and numbers[-1] == len(bounds)
        assert max(numbers.count(c) for c in set(numbers)) < 3 * 4000 / 16
    assert chunk_bounds(df, ["d"], 16) == [(datetime.date(2024, 5, 1),)]
    assert chunk_bounds(df, ["id"]) == [] == chunk_bounds(df.limit(0), ["id"], 16)


def test_nothing_is_written(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    count = lambda: sum(len(files) for _, _, files in os.walk(shared.removeprefix("file:")))
    before = count()
    df = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    assert with_running(df, ["k"], ["id"], chunks=8, rn=RowNumber(), s=RunningSum("id")).count() == 300
    assert count() == before
