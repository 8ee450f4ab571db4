"""Daily roll-ups that rewrite only the days that changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.partitions import partition_file_stats
from ledgerspark.sources.state import read_last_run, write_last_run
from ledgerspark.sources.versions import VersionedTable

BUCKET_MS = 1_000_000_000


def time_bucket(ts: Column) -> Column:
    """Partition value of a time: 1e9 ms, about 11.57 days."""
    return F.floor(F.unix_millis(ts.cast("timestamp")) / BUCKET_MS).cast("int")


def bucket_day(bucket: int) -> Column:
    """The day on which a bucket begins."""
    return F.to_date(F.timestamp_millis(F.lit(bucket).cast("bigint") * BUCKET_MS))


def daily_payments(ledger: DataFrame, since: Column | None = None) -> DataFrame:
    """Payments summed by day, subject, payee, account, business and store.

    With ``since``, only buckets that reach that day are read: a row's payments lie in the bucket
    (column hash) of the row.
    """
    if since is not None:
        ledger = ledger.filter(F.col("hash") >= time_bucket(since))
    paid = ledger.filter(F.col("payment").isNotNull()).select("biz", "store", F.explode("payment").alias("p"))
    paid = paid.withColumn("date", F.to_date("p.time"))
    if since is not None:
        paid = paid.filter(F.col("date") >= since)
    return paid.groupBy(
        "date", F.col("p.subject").alias("subject"), F.col("p.payee").alias("payee"), F.col("p.account").alias("account"),
        "biz", "store",
    ).agg(F.sum("p.amount").alias("amount"), F.count("p.amount").alias("payments"))


def roll_up_since(ledger: DataFrame, path: str, since: str) -> None:
    """Bring the roll-up, a ``VersionedTable`` by date, up to date: days from ``since`` on are computed, and replaced all at once."""
    first = F.lit(since).cast("date")
    VersionedTable(ledger.sparkSession, path, "date").replace_where(daily_payments(ledger, first), F.col("date") >= first)


def roll_up_changed(spark: SparkSession, ledger: str, schema: str, path: str, state: str, job: str = "roll-up") -> str | None:
    """One incremental run over a ledger in buckets (``hash`` directories of ``ledger``).

    From the first bucket with a file changed since the job's last run, the days are computed
    again and replaced; the newest change seen is then the job's last run. Returns the first day
    that was replaced, None when nothing had changed.
    """
    last = read_last_run(spark, state, job)
    stats = partition_file_stats(spark, ledger, "hash int")
    changed = stats.filter(F.col("max_time") > F.lit(last)).agg(F.min("hash").alias("lead"), F.max("max_time").alias("seen")).first()
    if changed["lead"] is None:
        return None
    since = str(spark.range(1).select(bucket_day(changed["lead"])).first()[0])
    roll_up_since(spark.read.schema(schema).parquet(ledger), path, since)
    write_last_run(spark, state, job, F.lit(changed["seen"]))
    return since


def day_table(spark: SparkSession, path: str) -> VersionedTable:
    """Rows by ``slot``, a day and a merchant."""
    return VersionedTable(spark, path, "slot")


def with_slot(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slot", F.concat_ws("|", F.col("date").cast("string"), "merchant"))


def load_days(rows: DataFrame, path: str, merchant: str, first: str) -> None:
    """Replace a merchant's days from ``first`` on in the ``day_table``, all of them at once and in one job."""
    mine = rows.filter((F.col("merchant") == merchant) & (F.col("date") >= F.lit(first).cast("date")))
    his = (F.substring_index("slot", "|", 1) >= F.lit(first)) & (F.expr("substr(slot, 12)") == F.lit(merchant))
    day_table(rows.sparkSession, path).replace_where(with_slot(mine), his)
