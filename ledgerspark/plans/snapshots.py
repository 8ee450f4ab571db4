"""Account snapshots that the diff, sync and merge queries compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import cents, table


def account_snapshot(spark: SparkSession, sf_dir: str, start: str, end: str, unknown: int = 0) -> DataFrame:
    """Per customer: orders of [start, end), their sum in cents, and the status of the last one.

    Moving the window gives natural inserts, deletes, updates and unchanged rows. With ``unknown``, every
    so many customers are one account without a number.
    """
    account = F.when(F.col("o_custkey") % unknown != 0, F.col("o_custkey")) if unknown else F.col("o_custkey")
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end)))
        .groupBy(account.alias("account"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(cents(F.col("o_totalprice"))).alias("total"),
            F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"),
        )
    )


OLD = ("1997-01-01", "1997-07-01")
NEW = ("1997-02-01", "1997-08-01")


UNKNOWN = 10


def snapshot_sql(start: str, end: str, unknown: int = 0) -> str:
    account = f"CASE WHEN o_custkey % {unknown} <> 0 THEN o_custkey END" if unknown else "o_custkey"
    return f"""SELECT {account} AS account, count(*) AS orders,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total,
        arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
      FROM orders WHERE o_orderdate >= TIMESTAMP '{start}' AND o_orderdate < TIMESTAMP '{end}'
      GROUP BY {account}"""


def with_snapshots(body: str) -> str:
    """SQL with the two snapshots as ``o`` and ``n``."""
    return f"WITH o AS ({snapshot_sql(*OLD)}), n AS ({snapshot_sql(*NEW)}) {body}"


def with_compared(body: str) -> str:
    """SQL with the two snapshots, one account of each without a number, side by side as ``both``."""
    change = """CASE WHEN o.there IS NULL THEN 'insert' WHEN n.there IS NULL THEN 'delete'
        WHEN n.orders IS DISTINCT FROM o.orders OR n.total IS DISTINCT FROM o.total THEN 'update'
        WHEN n.status IS DISTINCT FROM o.status THEN 'status' END"""
    return f"""WITH o AS (SELECT *, true AS there FROM ({snapshot_sql(*OLD, UNKNOWN)})),
        n AS (SELECT *, true AS there FROM ({snapshot_sql(*NEW, UNKNOWN)})),
        both_sides AS (SELECT coalesce(n.account, o.account) AS account, n.orders, n.total, n.status, n.there AS in_new, {change} AS change
            FROM n FULL JOIN o ON n.account IS NOT DISTINCT FROM o.account)
        {body}"""
