"""Ledger against provider bills: differences per order, carried forward between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import stored
from ledgerspark.sources.files import scan_csv

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Business types of provider B, and type prefixes of provider C.
B_TRADE, B_REFUND, B_FEE = "`交易", "`退款", "`扣除交易手续费"
C_TRADE, C_REFUND = "交易%", "退款%"


def text_cents(text: Column) -> Column:
    """Money text to whole cents, through decimals; null when it is no number."""
    return F.round(text.try_cast("decimal(38,18)") * 100, 0).cast("bigint")


def unmarked(c: str) -> Column:
    """Without the marker character that keeps spreadsheets from reading text as numbers."""
    return F.substr(F.col(c), F.lit(2))


def _time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def _bill(df: DataFrame, time: Column, order: Column, amount: Column) -> DataFrame:
    """Bills count against the ledger, so their sign is flipped."""
    return df.select(
        time.alias("pay_time"), F.coalesce(order, F.lit("")).alias("pay_order"), (-amount).alias("pay_amount")
    )


def load_bill_a(spark: SparkSession, path: str) -> DataFrame:
    """Columns trade_time, order_no, amount, refund, fee, each with a marker character."""
    rows = scan_csv(spark, path, header=True)

    def money(c: str) -> Column:
        return F.coalesce(text_cents(unmarked(c)), F.lit(0))

    amount = money("amount") - money("refund") - money("fee")
    return _bill(rows, _time(unmarked("trade_time")), unmarked("order_no"), amount)


def load_bill_b(spark: SparkSession, path: str) -> DataFrame:
    """Columns book_time, flow_no, business_type, amount: the type decides the sign."""
    rows = scan_csv(spark, path, header=True)
    kind, amount = F.col("business_type"), text_cents(unmarked("amount"))
    signed = F.when(kind == B_TRADE, amount).when(kind.isin(B_REFUND, B_FEE), -amount).otherwise(0)
    return _bill(rows, _time(unmarked("book_time")), unmarked("flow_no"), signed)


def load_bill_c(spark: SparkSession, path: str) -> DataFrame:
    """Columns done_time, trade_no, business_type, amount, service_fee; GB2312, ``#`` comments.

    Amounts are signed in the file. A row without a time counts from 2000-01-01.
    """
    rows = scan_csv(spark, path, encoding="GB2312", header=True, comment="#")
    kind = F.col("business_type")
    counted = F.when(kind.like(C_TRADE) | kind.like(C_REFUND), text_cents(F.col("amount")))
    fee = F.coalesce(text_cents(F.col("service_fee")), F.lit(0))

    def clean(c: str) -> Column:
        return F.replace(F.col(c), F.lit("\t"), F.lit(""))

    time = F.coalesce(F.try_to_timestamp(clean("done_time")), F.lit("2000-01-01").cast("timestamp"))
    return _bill(rows, time, clean("trade_no"), F.coalesce(counted, F.lit(0)) + fee)


def ledger_payments(ledger: DataFrame, start: str, end: str, min_hash: int | None = None) -> DataFrame:
    """Payments of the ledger in [start, end), one row each.

    ``ledger``: hash (partition), ts, payment array of structs (time, txn_no, amount, account),
    order struct (order_no). Buckets before ``min_hash`` are not read.
    """
    rows = ledger if min_hash is None else ledger.filter(F.col("hash") >= min_hash)
    paid = rows.select("ts", "order", F.explode("payment").alias("p"))
    return paid.filter((F.col("p.time") >= F.lit(start)) & (F.col("p.time") < F.lit(end))).select(
        F.col("ts").alias("time"),
        F.col("p.txn_no").alias("order_no"),
        F.col("order.order_no").alias("order_no2"),
        F.col("p.amount").alias("amount"),
        F.col("p.account").alias("account"),
    )


def load_bills(spark: SparkSession, a: str, b: str, c: str) -> DataFrame:
    """The bills of the three providers as one table."""
    return load_bill_a(spark, a).unionAll(load_bill_b(spark, b)).unionAll(load_bill_c(spark, c))


def bills_between(bills: DataFrame, start: str, end: str) -> DataFrame:
    return bills.filter((F.col("pay_time") >= F.lit(start)) & (F.col("pay_time") < F.lit(end)))


def match_bills(payments: DataFrame, bills: DataFrame) -> DataFrame:
    """Ledger and bill totals side by side per order, for accounts with at least one matched bill.

    Both sides are summed per order before the full join, so no order is hot in it. Accounts are
    selected by a semi join on their distinct list rather than by a window, which would bring
    all rows of a busy account together; a bill without a ledger row has a null account. The
    joined totals are read twice, so they are written to the shared folder once.
    """
    ledger = payments.groupBy("order_no", "order_no2").agg(
        F.sum("amount").alias("amount"), F.max("account").alias("account"), F.max("time").alias("local_time")
    )
    paid = bills.groupBy("pay_order").agg(F.sum("pay_amount").alias("pay_amount"), F.max("pay_time").alias("time"))
    # rows without a number match nothing; their second number keeps them from meeting in one task
    ledger = ledger.withColumns({"_numbered": F.col("order_no").isNotNull(), "_no": F.coalesce("order_no", "order_no2")})
    same = F.col("_numbered") & (F.col("_no") == F.col("pay_order"))
    both = stored(ledger.join(paid, same, "full").drop("_numbered", "_no"), "matched")
    covered = both.filter(F.col("pay_order").isNotNull()).select(F.col("account").alias("_account")).distinct()
    return both.join(covered, F.col("account").eqNullSafe(F.col("_account")), "left_semi")


def differences(matched: DataFrame) -> DataFrame:
    """Orders whose ledger and bill amounts do not add up to 0."""
    net = F.coalesce("amount", F.lit(0)) + F.coalesce("pay_amount", F.lit(0))
    return matched.select(
        F.coalesce("order_no", "pay_order").alias("order_no"),
        F.coalesce("order_no2", F.lit("")).alias("order_no2"),
        net.alias("amount"),
        F.coalesce("time", "local_time").alias("time"),
        "account",
    ).filter("amount <> 0")


def reconcile_bills(ledger: DataFrame, bills: DataFrame, start: str, end: str, min_hash: int | Column | None = None) -> DataFrame:
    return differences(match_bills(ledger_payments(ledger, start, end, min_hash), bills_between(bills, start, end)))


def carry_forward(current: DataFrame, last: DataFrame, start: str) -> DataFrame:
    """Differences found before ``start`` netted with the current ones; what is 0 is settled."""
    both = last.filter(F.col("time") < F.lit(start)).unionByName(current)
    return (
        both.groupBy("order_no", "order_no2")
        .agg(F.sum("amount").alias("amount"), F.max("time").alias("time"), F.max("account").alias("account"))
        .filter("amount <> 0")
    )


def report_accounts(matched: DataFrame) -> DataFrame:
    """Per account: orders, first and last time, days between them, and the account masked."""
    time = F.coalesce("local_time", "time")
    return (
        matched.filter(F.col("account").isNotNull())
        .groupBy(F.col("account").alias("account_no"))
        .agg(
            F.count(F.coalesce("order_no", "pay_order")).alias("orders"),
            F.max(time).alias("max_time"),
            F.min(time).alias("min_time"),
        )
        .withColumns(
            {
                "account_name": F.concat(F.left("account_no", F.lit(3)), F.lit("×××"), F.right("account_no", F.lit(4))),
                "days": F.datediff("max_time", "min_time"),
            }
        )
    )


def report_days(diff: DataFrame) -> DataFrame:
    return (
        diff.groupBy(F.date_format("time", "yyyy年MM月dd日").alias("date"))
        .agg(F.count("order_no").alias("orders"), F.sum("amount").alias("cents"))
        .select("date", "orders", F.round(F.col("cents") / 100, 2).alias("amount"))
        .orderBy(F.desc("date"))
    )


def report_top(diff: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` last order numbers among the differences."""
    return (
        diff.select(
            F.col("order_no").alias("order_id"),
            F.concat("order_no2", F.lit("\n")).alias("order_id2"),
            F.round(F.col("amount") / 100, 2).alias("delta"),
        )
        .orderBy(F.desc("order_id"), F.desc("order_id2"))
        .limit(n)
    )


def incremental_window(lead: DataFrame, changed: DataFrame, floor_day: str, period: str, today: Column) -> DataFrame:
    """One row (start, end): from the first day any source changed, for at most ``period``.

    ``lead``: smallest changed ledger bucket (column lead, buckets of 1e9 ms); ``changed``: first
    changed bill date (column day). Both have one row.
    """
    bucket = F.timestamp_millis(lead.select(F.col("lead").try_cast("bigint")).scalar() * 1_000_000_000)
    start = F.greatest(F.least(F.to_date(bucket), changed.select("day").scalar()), F.lit(floor_day).cast("date"))
    bounds = lead.select(start.alias("start"))
    return bounds.withColumn("end", F.least(F.to_date(F.col("start") + F.expr(f"interval {period}")), today))
