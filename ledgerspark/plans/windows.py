"""Ranks, runs, running values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import aggregates as agg
from ledgerspark.operators import relational as rel
from ledgerspark.operators import windows as win
from ledgerspark.operators.ordered import RowNumber, with_running
from ledgerspark.plans.registry import query
from ledgerspark.session import cents, table


@query(
    "dense_rank_scores",
    """SELECT o_orderkey, score, dense_rank() OVER (ORDER BY score DESC) AS rank
       FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS score FROM orders)""",
)
def dense_rank_scores(spark, sf):
    scores = table(spark, sf, "orders").select("o_orderkey", cents(F.col("o_totalprice")).alias("score"))
    return win.dense_rank_desc(scores, "score")


@query(
    "consecutive_n_values",
    """SELECT DISTINCT user_id, event_type FROM (
         SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
                  - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS run FROM events)
       GROUP BY user_id, event_type, run HAVING count(*) >= 3""",
)
def consecutive_n_values(spark, sf):
    return win.consecutive_values(table(spark, sf, "events"), ["user_id"], "event_id", "event_type", 3)


@query(
    "max_login_streak",
    """SELECT user_id, max(n) AS streak FROM (
         SELECT user_id, run, count(*) AS n FROM (
           SELECT user_id, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run
           FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)) GROUP BY 1, 2) GROUP BY user_id""",
)
def max_login_streak(spark, sf):
    return win.longest_streak(table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query(
    "avg_without_extremes",
    """SELECT c_nationkey, CAST(sum(salary) AS BIGINT) / count(*) AS average, count(*) AS rows_used FROM (
         SELECT c_nationkey, salary, rank() OVER (PARTITION BY c_nationkey ORDER BY salary) AS low,
           rank() OVER (PARTITION BY c_nationkey ORDER BY salary DESC) AS high
         FROM (SELECT c_nationkey, CAST(round(c_acctbal * 100) AS BIGINT) AS salary FROM customer))
       WHERE low > 1 AND high > 1 GROUP BY c_nationkey""",
)
def avg_without_extremes(spark, sf):
    salaries = table(spark, sf, "customer").select("c_nationkey", cents(F.col("c_acctbal")).alias("salary"))
    return agg.average_without_extremes(salaries, "c_nationkey", "salary")


@query(
    "window_sum_partition_filter",
    """SELECT o_orderkey, o_custkey FROM (
         SELECT o_orderkey, o_custkey, sum(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY o_custkey) AS hits FROM orders) WHERE hits > 0""",
)
def window_sum_partition_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    matching = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return agg.keep_groups_with(orders, "o_custkey", matching).select("o_orderkey", "o_custkey")


@query(
    "window_sum_global",
    """SELECT c_custkey, balance, CAST(sum(balance) OVER () AS BIGINT) AS total
       FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer)""",
)
def window_sum_global(spark, sf):
    balances = table(spark, sf, "customer").select("c_custkey", cents(F.col("c_acctbal")).alias("balance"))
    return balances.withColumn("total", balances.agg(F.sum("balance")).scalar())


@query(
    "row_number_per_key",
    "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events",
)
def row_number_per_key(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts", "event_id")
    return with_running(events, ["event_type"], ["ts", "event_id"], rn=RowNumber()).drop("ts")


@query(
    "merge_last_non_null",
    """SELECT user_id, event_id, last_value(purchase IGNORE NULLS) OVER w AS purchase,
         last_value(signup IGNORE NULLS) OVER w AS signup, last_value(view IGNORE NULLS) OVER w AS view
       FROM (SELECT user_id, ts, event_id, CASE WHEN event_type = 'purchase' THEN value END AS purchase,
               CASE WHEN event_type = 'signup' THEN value END AS signup,
               CASE WHEN event_type = 'view' THEN value END AS view FROM events)
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def merge_last_non_null(spark, sf):
    seen = F.struct(
        *[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in ("purchase", "signup", "view")]
    )
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", seen.alias("seen"))
    return win.merge_last_non_null(events, "seen", ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "seen.*")


@query(
    "swap_adjacent_seats",
    """SELECT CASE WHEN seat % 2 = 0 THEN seat - 1 WHEN seat = n THEN seat ELSE seat + 1 END AS seat, p_name
       FROM (SELECT p_partkey + 1 AS seat, p_name, (SELECT count(*) FROM part) AS n FROM part)""",
)
def swap_adjacent_seats(spark, sf):
    seats = table(spark, sf, "part").select((F.col("p_partkey") + 1).alias("seat"), "p_name")
    return rel.swap_adjacent(seats, "seat")


@query(
    "max_trading_profit",
    """SELECT user_id, CAST(coalesce(sum(greatest(step, 0)), 0) AS BIGINT) AS profit FROM (
         SELECT user_id, lead(price) OVER (PARTITION BY user_id ORDER BY day) - price AS step FROM (
           SELECT user_id, CAST(ts AS DATE) AS day, arg_max(CAST(round(value * 100) AS BIGINT), (ts, event_id)) AS price
           FROM events GROUP BY 1, 2)) GROUP BY user_id""",
)
def max_trading_profit(spark, sf):
    closing = (
        table(spark, sf, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.max_by(cents(F.col("value")), F.struct("ts", "event_id")).alias("price"))
    )
    return agg.price_rises(closing, ["user_id"], "day", "price")
