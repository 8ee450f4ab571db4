"""Streams of landed files into tables. Each run reads what is new and stops (``availableNow``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerspark.session import stored
from ledgerspark.sources.files import audit_rows
from ledgerspark.sources.latest import GONE, LatestTable
from ledgerspark.sources.versions import VersionedTable

#: State that need not fit in memory and of which a batch saves only its changes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch has its own directory, so a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a table, exactly once."""
    _run(stream, checkpoint, lambda df, n: _write_batch(df, path, n))


def audit_on_insert(stream: DataFrame, path: str, audit_path: str, checkpoint: str, id_col: str, name_col: str) -> None:
    """Append a stream to a table and (id, name) of each row to its audit table."""

    def each(df: DataFrame, batch_id: int) -> None:
        _write_batch(df, path, batch_id)
        # read back rather than computed twice
        written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch={batch_id}")
        _write_batch(audit_rows(written, id_col, name_col), audit_path, batch_id)

    _run(stream, checkpoint, each)


def daily_rollup(stream: DataFrame, ts: str, keys: Sequence[str], amount: Column, path: str, checkpoint: str) -> None:
    """Sums per day and key, as a ``VersionedTable`` by date with one row per day and key.

    A batch is summed first, within its tasks before anything is shuffled. Its days, and those only, are read,
    added to and replaced all at once. A row counts on its day however late it comes, so there is no
    watermark behind which rows are lost, and no state beside the table. Rows carry the number of the
    batch that wrote them, so one that is repeated finds its own number and adds nothing. Rows without a time
    belong to no day.
    """
    spark = stream.sparkSession
    totals, key = VersionedTable(spark, path, "date"), ["date", *keys]

    def each(df: DataFrame, batch: int) -> None:
        dated = df.select(F.to_date(F.col(ts).cast("timestamp")).alias("date"), *keys, amount.alias("amount")).filter("date IS NOT NULL")
        fresh = stored(dated.groupBy(*key).agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("payments")), "batch")
        days = [r.date for r in fresh.select("date").distinct().collect()]  # the batch's days
        if not days:
            return
        if totals.exists():
            known = totals.read().filter(F.col("date").isin(days))
            last = known.agg(F.max("batch")).first()[0]
            if last is not None and last >= batch:
                return
            fresh = fresh.unionByName(known.drop("batch"))
        sums = [F.sum(c).cast(fresh.schema[c].dataType).alias(c) for c in ("amount", "payments")]
        totals.replace_partitions(fresh.groupBy(*key).agg(*sums).withColumn("batch", F.lit(batch).cast("bigint")), days)

    _run(stream, checkpoint, each)


def changelog_latest(
    stream: DataFrame, keys: Sequence[str], log_id: str, path: str, checkpoint: str, buckets: int,
    gone: Column | None = None, fold_after: int = 16,
) -> None:
    """Latest entry of each key, by ``log_id``, as a ``LatestTable``; entries that meet ``gone`` remove their key.

    The state store holds the newest entry of each key, and a batch brings its keys' up to date, with partial
    aggregation for hot keys. So a batch costs what its keys cost: it reads no table and writes their
    entries only. After every ``fold_after`` batches these are folded into the table's base, in the
    buckets they touch. An entry that is not newer is late and changes nothing, also where its key was
    removed: only a newer entry brings a key back. Entries without a number, and repeated batches, change nothing.
    """
    spark = stream.sparkSession
    table = LatestTable(spark, path, keys, log_id, buckets)
    removes = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    rest = [c for c in stream.columns if c not in keys]
    entry = F.struct(*rest, removes.alias(GONE))
    newest = stream.groupBy(*keys).agg(F.max_by(entry, log_id).alias("l")).filter("l IS NOT NULL").select(*keys, "l.*")

    def each(df: DataFrame, batch: int) -> None:
        table.add(df, batch)
        if (batch + 1) % fold_after == 0:
            table.fold()

    before = {c: spark.conf.get(c, None) for c in STATE}
    for c, v in STATE.items():
        spark.conf.set(c, v)
    try:
        _run(newest, checkpoint, each, mode="update")
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)


def batches(spark: SparkSession, checkpoint: str) -> int:
    """Batches that are done, over all runs from a checkpoint."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/[0-9]*")
    return len(commits.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(commits) or [])
