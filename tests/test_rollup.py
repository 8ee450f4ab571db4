"""Incremental jobs read and rewrite only what changed."""

from pyspark.sql import functions as F

from ledgerspark.operators import reconcile as rc
from ledgerspark.operators import rollup
from ledgerspark.sources import state
from ledgerspark.sources.files import write_partitioned
from ledgerspark.sources.versions import VersionedTable

LEDGER = """ts timestamp, payment array<struct<time: timestamp, subject: string, payee: string, account: string, amount: bigint>>,
    biz struct<no: string>, store struct<no: string>, hash int"""


def entries(spark, *rows):
    """(time, amount) as ledger rows."""
    df = spark.createDataFrame(rows, "t string, amount long").withColumn("ts", F.to_timestamp("t"))
    payment = F.struct(F.col("ts").alias("time"), F.lit("s").alias("subject"), F.lit("p").alias("payee"), F.lit("a").alias("account"), "amount")
    no = F.struct(F.lit("1").alias("no"))
    return df.select("ts", F.array(payment).alias("payment"), no.alias("biz"), no.alias("store"), rollup.time_bucket(F.col("ts")).alias("hash"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_changed_buckets_are_rolled_up_again(spark, tmp_path):
    ledger, path, runs = (str(tmp_path / n) for n in ("ledger", "rollup", "state"))
    write_partitioned(entries(spark, ("2024-01-02 10:00:00", 1), ("2024-01-20 10:00:00", 2), ("2024-02-20 10:00:00", 4)), ledger, "hash")
    assert rollup.roll_up_changed(spark, ledger, LEDGER, path, runs) is not None
    assert rollup.roll_up_changed(spark, ledger, LEDGER, path, runs) is None
    days = VersionedTable(spark, path, "date")
    first = {r.directory.split("/")[1]: r.directory for r in days._manifest(days.versions()[-1])}
    reader = days.read()  # as of now, whatever is replaced later
    # two more payments on a day that has one, before and after the start of its bucket
    write_partitioned(entries(spark, ("2024-02-20 11:00:00", 8)), ledger, "hash", mode="append")
    since = rollup.roll_up_changed(spark, ledger, LEDGER, path, runs)
    assert "2024-01-20" < since <= "2024-02-20"
    assert {str(r.date): r.amount for r in days.read().collect()} == {"2024-01-02": 1, "2024-01-20": 2, "2024-02-20": 12}
    again = {r.directory.split("/")[1]: r.directory for r in days._manifest(days.versions()[-1])}
    assert {d for d in first if first[d] != again[d]} <= {"date=2024-02-20"}
    assert {str(r.date): r.amount for r in reader.collect()} == {"2024-01-02": 1, "2024-01-20": 2, "2024-02-20": 4}


def test_a_merchants_days_are_replaced_at_once(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = lambda *r: spark.createDataFrame(r, "d string, merchant string, amount int").select(F.to_date("d").alias("date"), "merchant", "amount")
    days = rollup.day_table(spark, path)
    days.write(rollup.with_slot(rows(("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "a", 3), ("2024-01-02", "b", 4), ("2024-01-03", "a|b", 5))))
    before = days.read()
    rollup.load_days(rows(("2024-01-01", "a", 10), ("2024-01-02", "a", 20), ("2024-01-04", "a", 40), ("2024-01-02", "b", 9)), path, "a", "2024-01-02")
    seen = lambda df: sorted((str(r.date), r.merchant, r.amount) for r in df.collect())
    assert seen(days.read()) == [("2024-01-01", "a", 1), ("2024-01-02", "a", 20), ("2024-01-02", "b", 4), ("2024-01-03", "a|b", 5), ("2024-01-04", "a", 40)]
    assert len(seen(before)) == 5 and ("2024-01-03", "a", 3) in seen(before)


def test_a_day_that_begins_in_the_bucket_before_is_whole(spark, tmp_path):
    bucket = 1700  # begins within a day
    day = str(spark.range(1).select(rollup.bucket_day(bucket)).first()[0])
    start = spark.range(1).select(F.timestamp_millis(F.lit(bucket * rollup.BUCKET_MS))).first()[0]
    before = f"{day} 00:00:01"
    ledger = entries(spark, (before, 1), (str(start), 2))
    assert sorted(r.hash for r in ledger.collect()) == [bucket - 1, bucket]
    rows = rollup.daily_payments(ledger, F.lit(day).cast("date")).collect()
    assert [(str(r.date), r.amount) for r in rows] == [(day, 3)]


def test_ledger_scans_are_pruned(spark, tmp_path):
    path = str(tmp_path / "ledger")
    write_partitioned(entries(spark, ("2024-01-02 10:00:00", 1), ("2024-02-20 10:00:00", 4)), path, "hash")
    ledger = spark.read.schema(LEDGER).parquet(path)
    daily = rollup.daily_payments(ledger, F.lit("2024-02-01").cast("date"))
    assert daily.count() == 1 and "PartitionFilters: [isnotnull(hash" in plan(daily)
    with_txn = ledger.select(
        "hash", "ts", F.transform("payment", lambda p: p.withField("txn_no", F.lit("t"))).alias("payment"), F.struct(F.lit("o").alias("order_no")).alias("order")
    )
    first = rollup.time_bucket(F.lit("2024-02-01").cast("timestamp"))
    payments = rc.ledger_payments(with_txn, "2024-02-01", "2024-03-01", first)
    assert payments.count() == 1 and "PartitionFilters: [isnotnull(hash" in plan(payments)


def test_job_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert str(state.read_last_run(spark, path, "a")).startswith("2000-01-01")
    for day in ("2024-01-05", "2024-01-03"):
        state.write_last_run(spark, path, "a", F.lit(day))
    state.write_last_run(spark, path, "b", F.lit("2030-01-01"))
    assert str(state.read_last_run(spark, path, "a")).startswith("2024-01-05")
