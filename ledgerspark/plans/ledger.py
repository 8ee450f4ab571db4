"""Reconciliation and roll-ups of a payment ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import reconcile as rc
from ledgerspark.operators import rollup
from ledgerspark.plans.registry import query
from ledgerspark.session import cents, new_path, stored, table
from ledgerspark.sources import partitions as pt
from ledgerspark.sources.files import write_csv, write_partitioned
from ledgerspark.sources.versions import VersionedTable

START, END = "1996-01-01", "1999-01-01"
EARLIER = ("1995-06-01", "1996-02-01")


def line_ledger(spark, sf):
    """Lines as ledger entries: one payment per line, booked on the supplier's account."""
    ship, supplier = F.col("l_shipdate"), F.col("l_suppkey").cast("string")
    account = F.concat(F.lit("ACC"), F.repeat(F.lit("0"), F.lit(8) - F.length(supplier)), supplier)
    payment = F.struct(
        ship.alias("time"),
        F.col("l_orderkey").cast("string").alias("txn_no"),
        cents(F.col("l_extendedprice")).alias("amount"),
        account.alias("account"),
    )
    return table(spark, sf, "lineitem").select(
        rollup.time_bucket(ship).alias("hash"),
        ship.alias("ts"),
        F.array(payment).alias("payment"),
        F.struct(F.concat(F.lit("ON"), F.col("l_orderkey").cast("string")).alias("order_no")).alias("order"),
    )


LEDGER = """ts timestamp_ntz, payment array<struct<time: timestamp_ntz, txn_no: string, amount: bigint, account: string>>,
    `order` struct<order_no: string>, hash int"""


def bucketed_ledger(spark, sf):
    """The ledger as it is kept: a directory per time bucket."""
    path = new_path(spark, "ledger")
    write_partitioned(line_ledger(spark, sf), path, "hash")
    return spark.read.schema(LEDGER).parquet(path)


def provider_bills(spark, sf):
    """The bills as the three providers send them, each for a third of the suppliers, read back."""
    lines = table(spark, sf, "lineitem").filter(~((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45)))
    late = F.when(F.col("l_tax") > 0.07, F.expr("l_shipdate + interval 1 day")).otherwise(F.col("l_shipdate"))
    rows = lines.select(
        (F.col("l_suppkey") % 3).alias("provider"),
        F.date_format(late, "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("l_orderkey").cast("string").alias("no"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    mark, zero = F.lit("`"), F.lit(0).cast("decimal(12,2)")
    paths = {p: new_path(spark, f"bill-{p}") for p in "abc"}
    a = rows.filter("provider = 0").select(
        F.concat(mark, "time").alias("trade_time"), F.concat(mark, "no").alias("order_no"), F.concat(mark, "price").alias("amount"),
        F.concat(mark, F.when(F.col("returned"), F.col("price")).otherwise(zero)).alias("refund"), F.concat(mark, zero).alias("fee"),
    )
    write_csv(a, paths["a"], header=True)
    # the other two book a refund as a line of its own
    booked = F.explode(F.when(F.col("returned"), F.array(F.lit("交易"), F.lit("退款"))).otherwise(F.array(F.lit("交易")))).alias("kind")
    split = rows.select("provider", "time", "no", "price", booked)
    b = split.filter("provider = 1").select(
        F.concat(mark, "time").alias("book_time"), F.concat(mark, "no").alias("flow_no"),
        F.concat(mark, "kind").alias("business_type"), F.concat(mark, "price").alias("amount"),
    )
    write_csv(b, paths["b"], header=True)
    signed = F.when(F.col("kind") == "退款", -F.col("price")).otherwise(F.col("price"))
    c = split.filter("provider = 2").select(
        F.col("time").alias("done_time"), F.concat("no", F.lit("\t")).alias("trade_no"), F.col("kind").alias("business_type"),
        signed.alias("amount"), zero.alias("service_fee"),
    )
    write_csv(c, paths["c"], encoding="GB2312", header=True)
    return rc.load_bills(spark, paths["a"], paths["b"], paths["c"])


def line_bills(spark, sf):
    """What a provider bills for the lines: returned lines are refunded, highly taxed ones booked a
    day later, and large open ones not billed at all."""
    price = cents(F.col("l_extendedprice"))
    refund = F.when(F.col("l_returnflag") == "R", price).otherwise(0)
    late = F.when(F.col("l_tax") > 0.07, F.expr("l_shipdate + interval 1 day")).otherwise(F.col("l_shipdate"))
    return (
        table(spark, sf, "lineitem")
        .filter(~((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45)))
        .select(
            late.alias("pay_time"), F.col("l_orderkey").cast("string").alias("pay_order"), (refund - price).alias("pay_amount")
        )
    )


def matched_sql(name: str, start: str, end: str) -> str:
    return f"""{name}_l AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_no, 'ON' || l_orderkey AS order_no2,
        sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS amount, max(printf('ACC%08d', l_suppkey)) AS account,
        max(l_shipdate) AS local_time
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{start}' AND l_shipdate < TIMESTAMP '{end}' GROUP BY 1, 2),
    {name}_b AS (SELECT CAST(l_orderkey AS VARCHAR) AS pay_order,
        sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE -CAST(round(l_extendedprice * 100) AS BIGINT) END) AS pay_amount,
        max(t) AS time
      FROM (SELECT *, CASE WHEN l_tax > 0.07 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS t FROM lineitem
            WHERE NOT (l_linestatus = 'O' AND l_quantity > 45))
      WHERE t >= TIMESTAMP '{start}' AND t < TIMESTAMP '{end}' GROUP BY 1),
    {name}_m AS (SELECT * FROM (SELECT *, sum(CASE WHEN pay_order IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY account) AS hits
      FROM {name}_l FULL JOIN {name}_b ON order_no = pay_order) WHERE hits > 0),
    {name} AS (SELECT coalesce(order_no, pay_order) AS order_no, coalesce(order_no2, '') AS order_no2,
        CAST(coalesce(amount, 0) + coalesce(pay_amount, 0) AS BIGINT) AS amount, coalesce(time, local_time) AS time, account
      FROM {name}_m WHERE coalesce(amount, 0) + coalesce(pay_amount, 0) <> 0)"""


def day_text(df):
    return df.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))


TIME_SQL = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time"


@query(
    "reconcile_bills",
    f"WITH {matched_sql('cur', START, END)} SELECT order_no, order_no2, amount, {TIME_SQL}, account FROM cur",
)
def reconcile_bills(spark, sf):
    first = rollup.time_bucket(F.lit(START).cast("timestamp"))
    return day_text(rc.reconcile_bills(bucketed_ledger(spark, sf), provider_bills(spark, sf), START, END, min_hash=first))


@query(
    "reconcile_carry_forward",
    f"""WITH {matched_sql('cur', START, END)}, {matched_sql('old', *EARLIER)}
        SELECT order_no, order_no2, CAST(sum(amount) AS BIGINT) AS amount, strftime(max(time), '%Y-%m-%d %H:%M:%S') AS time,
          max(account) AS account
        FROM (SELECT * FROM old WHERE time < TIMESTAMP '{START}' UNION ALL SELECT * FROM cur)
        GROUP BY 1, 2 HAVING sum(amount) <> 0""",
)
def reconcile_carry_forward(spark, sf):
    ledger, bills = bucketed_ledger(spark, sf), line_bills(spark, sf)

    def found(start, end):
        return rc.reconcile_bills(ledger, bills, start, end, min_hash=rollup.time_bucket(F.lit(start).cast("timestamp")))

    return day_text(rc.carry_forward(found(START, END), found(*EARLIER), START))


def matched(spark, sf):
    """The match behind the three tables of a report, read from the tables as they are now; a caller who
    wants several of them passes the one it returns."""
    payments = rc.ledger_payments(line_ledger(spark, sf), START, END)
    return stored(rc.match_bills(payments, rc.bills_between(line_bills(spark, sf), START, END)), "report")


@query(
    "reconcile_report",
    f"""WITH {matched_sql('cur', START, END)}
        SELECT account AS account_no, count(coalesce(order_no, pay_order)) AS orders,
          left(account, 3) || '×××' || right(account, 4) AS account_name,
          strftime(max(coalesce(local_time, time)), '%Y-%m-%d') AS max_time,
          strftime(min(coalesce(local_time, time)), '%Y-%m-%d') AS min_time,
          CAST(date_diff('day', CAST(min(coalesce(local_time, time)) AS DATE), CAST(max(coalesce(local_time, time)) AS DATE)) AS INTEGER) AS days
        FROM cur_m WHERE account IS NOT NULL GROUP BY account""",
)
def reconcile_report(spark, sf, match=None):
    out = rc.report_accounts(matched(spark, sf) if match is None else match)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("max_time", "min_time")})


@query(
    "reconcile_report_days",
    f"""WITH {matched_sql('cur', START, END)}
        SELECT strftime(time, '%Y年%m月%d日') AS date, count(order_no) AS orders,
          round(CAST(sum(amount) AS DOUBLE) / 100, 2) AS amount FROM cur GROUP BY 1""",
)
def reconcile_report_days(spark, sf, match=None):
    return rc.report_days(rc.differences(matched(spark, sf) if match is None else match))


@query(
    "reconcile_report_top",
    f"""WITH {matched_sql('cur', START, END)}
        SELECT order_no AS order_id, order_no2 || chr(10) AS order_id2, round(CAST(amount AS DOUBLE) / 100, 2) AS delta
        FROM cur ORDER BY order_id DESC, order_id2 DESC LIMIT 100""",
)
def reconcile_report_top(spark, sf, match=None):
    return rc.report_top(rc.differences(matched(spark, sf) if match is None else match))


def payment_events(spark, sf):
    """Events as ledger rows for the roll-up."""
    payment = F.struct(
        F.col("ts").alias("time"),
        F.col("event_type").alias("subject"),
        F.lit("owner").alias("payee"),
        F.concat(F.lit("A"), F.get_json_object("props", "$.k")).alias("account"),
        cents(F.col("value")).alias("amount"),
    )
    user = F.col("user_id").cast("string")
    return table(spark, sf, "events").select(
        rollup.time_bucket(F.col("ts")).alias("hash"), "ts", F.array(payment).alias("payment"), F.struct(user.alias("no")).alias("biz"), F.struct(F.lit("S1").alias("no")).alias("store")
    )


@query(
    "daily_rollup_incremental",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS subject, 'owner' AS payee,
         'A' || json_extract_string(props, '$.k') AS account, CAST(user_id AS VARCHAR) AS biz, 'S1' AS store,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount, count(*) AS payments
       FROM events GROUP BY ALL""",
)
def daily_rollup_incremental(spark, sf):
    path, ledger, state = (new_path(spark, label) for label in ("rollup", "ledger", "state"))
    events = payment_events(spark, sf)
    early = F.col("ts") < F.lit("2024-01-18 12:00:00")
    # a first run sees the ledger up to the 18th at noon, the next one what came in since
    for part in (events.filter(early), events.filter(~early)):
        write_partitioned(part, ledger, "hash", mode="append")
        rollup.roll_up_changed(spark, ledger, events.schema, path, state)
    out = VersionedTable(spark, path, "date").read()
    return out.select(
        F.col("date").cast("string").alias("date"), "subject", "payee", "account", F.col("biz.no").alias("biz"),
        F.col("store.no").alias("store"), "amount", "payments",
    )


def daily_merchants(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("merchant"), "user_id")
        .agg(F.sum(cents(F.col("value"))).alias("amount"))
    )


@query(
    "incremental_day_loop",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS merchant, user_id,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount
       FROM events WHERE event_type = 'purchase' OR ts < TIMESTAMP '2024-01-20' GROUP BY ALL""",
)
def incremental_day_loop(spark, sf):
    path = new_path(spark, "days")
    rows = daily_merchants(spark, sf)
    days = rollup.day_table(spark, path)
    days.write(rollup.with_slot(rows.filter("date < date '2024-01-20'")))
    rollup.load_days(rows, path, "purchase", "2024-01-20")
    return days.read().select(F.col("date").cast("string").alias("date"), "merchant", "user_id", "amount")


def ledger_files(spark, sf):
    """Orders laid out by time bucket."""
    path = new_path(spark, "ledger")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    write_partitioned(orders.withColumn("hash", rollup.time_bucket(F.col("o_orderdate"))), path, "hash")
    return path


def bill_files(spark, sf):
    """Orders in directories that carry their month, as bills do."""
    path = new_path(spark, "bills")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    write_partitioned(orders.withColumn("bill_month", F.date_format("o_orderdate", "yyyy-MM-01")), path, "bill_month")
    return path


LONG_AGO = "2001-01-01"
BILL_PATTERN = (r"bill_month=(.{10})", "yyyy-MM-dd")


@query(
    "partition_file_stats",
    """SELECT DISTINCT CAST(floor(epoch_ms(o_orderdate) / 1000000000) AS INTEGER) AS hash, true AS in_order FROM orders""",
)
def partition_file_stats(spark, sf):
    stats = pt.partition_file_stats(spark, ledger_files(spark, sf), "hash int", lo=LONG_AGO)
    return stats.select("hash", (F.col("min_time") <= F.col("max_time")).alias("in_order"))


@query(
    "lead_partition",
    "SELECT min(CAST(CAST(floor(epoch_ms(o_orderdate) / 1000000000) AS INTEGER) AS VARCHAR)) AS lead FROM orders",
)
def lead_partition(spark, sf):
    return pt.lead_partition(spark, ledger_files(spark, sf), "hash", LONG_AGO)


@query("earliest_changed_bill_date", "SELECT strftime(min(o_orderdate), '%Y-%m-01') AS day FROM orders")
def earliest_changed_bill_date(spark, sf):
    found = pt.earliest_changed_bill_date(spark, [(bill_files(spark, sf), *BILL_PATTERN)], LONG_AGO)
    return found.select(F.col("day").cast("string").alias("day"))


@query(
    "incremental_window",
    """SELECT CAST(f AS VARCHAR) AS start, CAST(least(CAST(f + INTERVAL 3 MONTH AS DATE), last) AS VARCHAR) AS "end"
       FROM (SELECT greatest(least(CAST(to_timestamp(floor(epoch_ms(min(o_orderdate)) / 1000000000) * 1000000) AS DATE),
                    CAST(date_trunc('month', min(o_orderdate)) AS DATE)), DATE '1994-12-30') AS f,
               CAST(max(o_orderdate) AS DATE) AS last FROM orders)""",
)
def incremental_window(spark, sf):
    lead = pt.lead_partition(spark, ledger_files(spark, sf), "hash", LONG_AGO)
    changed = pt.earliest_changed_bill_date(spark, [(bill_files(spark, sf), *BILL_PATTERN)], LONG_AGO)
    today = table(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate"))).scalar()
    bounds = rc.incremental_window(lead, changed, "1994-12-30", "3 months", today)
    return bounds.select(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"))
