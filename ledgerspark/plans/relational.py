"""Projections, filters, joins, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import relational as rel
from ledgerspark.plans.registry import query
from ledgerspark.plans.snapshots import NEW, OLD, account_snapshot, with_snapshots
from ledgerspark.session import cents, table


@query(
    "filter_or",
    "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 45 OR p_retailprice > 1080",
)
def filter_or(spark, sf):
    part = table(spark, sf, "part")
    return part.filter((F.col("p_size") > 45) | (F.col("p_retailprice") > 1080)).select("p_partkey", "p_name", "p_size")


@query(
    "filter_odd_not_equal_sorted",
    """SELECT event_id, event_type, value FROM events
       WHERE event_id % 2 = 1 AND event_type <> 'error' ORDER BY value DESC, event_id""",
)
def filter_odd_not_equal_sorted(spark, sf):
    return (
        table(spark, sf, "events")
        .filter((F.col("event_id") % 2 == 1) & (F.col("event_type") != "error"))
        .select("event_id", "event_type", "value")
        .orderBy(F.desc("value"), "event_id")
    )


@query("filter_between_sql", "SELECT p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def filter_between_sql(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("filter_between_part")
    return spark.sql("SELECT p_name, p_size FROM filter_between_part WHERE p_size BETWEEN 13 AND 19")


@query(
    "filter_row_lambda",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <> 0",
)
def filter_row_lambda(spark, sf):
    return table(spark, sf, "lineitem").filter(F.col("l_discount") != 0).select("l_orderkey", "l_linenumber", "l_discount")


@query("map_rows", "SELECT 'Name: ' || c_name AS label, c_custkey + 1 AS next_key FROM customer")
def map_rows(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit("Name: "), "c_name").alias("label"), (F.col("c_custkey") + 1).alias("next_key")
    )


@query(
    "project_drop_struct_expand",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders""",
)
def project_drop_struct_expand(spark, sf):
    return (
        table(spark, sf, "orders")
        .selectExpr("struct(*) AS o", "cast(round(o_totalprice * 100) AS bigint) AS total")
        .select("o.*", "total")
        .drop("o_totalprice", "o_orderdate")
    )


@query(
    "filter_half_open_time",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'""",
)
def filter_half_open_time(spark, sf):
    return (
        table(spark, sf, "orders")
        .filter("o_orderdate >= timestamp_ntz '1996-01-01' AND o_orderdate < timestamp_ntz '1996-02-01'")
        .select("o_orderkey", "o_custkey")
    )


@query(
    "index_point_lookup",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS price
       FROM lineitem WHERE l_orderkey = 42""",
)
def index_point_lookup(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter(F.col("l_orderkey") == 42)
        .select("l_orderkey", "l_partkey", "l_linenumber", cents(F.col("l_extendedprice")).alias("price"))
    )


@query(
    "join_left_optional",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
)
def join_left_optional(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@query(
    "join_chain_left_count",
    """SELECT n.n_nationkey, n.n_name, count(l.l_extendedprice) AS line_count
       FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
       LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
       GROUP BY n.n_nationkey, n.n_name""",
)
def join_chain_left_count(spark, sf):
    # counted per order and per customer before each join, so the joins carry counts, not lines
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("l_extendedprice").alias("n"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(F.sum("n").alias("n"))
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    nation = table(spark, sf, "nation")
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .groupBy("n_nationkey", "n_name")
        .agg(F.sum("n").alias("line_count"))
    )


@query(
    "join_inner_titles_count",
    """SELECT n.n_nationkey, n.n_name, r.r_name, c.c_mktsegment AS title, count(*) AS title_count
       FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey JOIN customer c ON c.c_nationkey = n.n_nationkey
       GROUP BY n.n_nationkey, n.n_name, r.r_name, c.c_mktsegment""",
)
def join_inner_titles_count(spark, sf):
    titles = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey", F.col("c_mktsegment").alias("title"))
        .agg(F.count(F.lit(1)).alias("title_count"))
    )
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        titles.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name", "title", "title_count")
    )


@query(
    "join_earns_more_than_manager",
    """SELECT a.c_custkey AS emp_no, b.manager_no, CAST(round(c.c_acctbal * 100) AS BIGINT) AS emp_salary,
         CAST(round(d.c_acctbal * 100) AS BIGINT) AS manager_salary
       FROM customer a JOIN (SELECT c_nationkey, min(c_custkey) AS manager_no FROM customer GROUP BY c_nationkey) b
         ON a.c_nationkey = b.c_nationkey
       JOIN customer c ON c.c_custkey = a.c_custkey JOIN customer d ON d.c_custkey = b.manager_no
       WHERE c.c_acctbal > d.c_acctbal""",
)
def join_earns_more_than_manager(spark, sf):
    dept_emp = table(spark, sf, "customer").select(F.col("c_custkey").alias("emp_no"), F.col("c_nationkey").alias("dept"))
    salaries = table(spark, sf, "customer").select(F.col("c_custkey").alias("no"), cents(F.col("c_acctbal")).alias("salary"))
    managers = (
        dept_emp.groupBy(F.col("dept").alias("managed"))
        .agg(F.min("emp_no").alias("manager_no"))
        .join(salaries.withColumnRenamed("salary", "manager_salary"), F.col("manager_no") == F.col("no"))
        .drop("no")
    )
    return (
        dept_emp.join(salaries.withColumnRenamed("salary", "emp_salary"), F.col("emp_no") == F.col("no"))
        .join(managers, F.col("dept") == F.col("managed"))
        .filter("emp_salary > manager_salary")
        .select("emp_no", "manager_no", "emp_salary", "manager_salary")
    )


@query(
    "join_right_pivot",
    """SELECT b.conv_id, a.turn AS system_turn, b.user_text, b.assistant_text
       FROM (SELECT conv_id, turn FROM conversations WHERE role = 'system') a
       RIGHT JOIN (SELECT conv_id, max(CASE WHEN role = 'user' THEN text END) AS user_text,
                     max(CASE WHEN role = 'assistant' THEN text END) AS assistant_text
                   FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id) b
       ON b.conv_id = a.conv_id""",
)
def join_right_pivot(spark, sf):
    turns = table(spark, sf, "conversations")
    system = turns.filter("role = 'system'").select("conv_id", F.col("turn").alias("system_turn"))
    pivoted = (
        turns.filter("role IN ('user', 'assistant')")
        .groupBy("conv_id")
        .agg(
            F.max(F.when(F.col("role") == "user", F.col("text"))).alias("user_text"),
            F.max(F.when(F.col("role") == "assistant", F.col("text"))).alias("assistant_text"),
        )
    )
    return system.join(pivoted, "conv_id", "right").select("conv_id", "system_turn", "user_text", "assistant_text")


def ledger_and_bill(spark, sf):
    """Order totals and line sums per order, both in cents and unique per order."""
    ledger = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderkey").alias("order_no"))
        .agg(F.sum(cents(F.col("o_totalprice"))).alias("ledger"))
    )
    bill = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("bill_no"))
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("bill"))
    )
    return ledger, bill


@query(
    "join_full_outer",
    """SELECT coalesce(o.order_no, l.bill_no) AS order_no, o.ledger, l.bill,
         CASE WHEN l.bill_no IS NULL THEN 'ledger' WHEN o.order_no IS NULL THEN 'bill' ELSE 'both' END AS side
       FROM (SELECT o_orderkey AS order_no, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS ledger
             FROM orders GROUP BY 1) o
       FULL JOIN (SELECT l_orderkey AS bill_no, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS bill
             FROM lineitem GROUP BY 1) l ON o.order_no = l.bill_no""",
)
def join_full_outer(spark, sf):
    ledger, bill = ledger_and_bill(spark, sf)
    side = F.when(F.col("bill_no").isNull(), "ledger").when(F.col("order_no").isNull(), "bill").otherwise("both")
    return ledger.join(bill, F.col("order_no") == F.col("bill_no"), "full").select(
        F.coalesce("order_no", "bill_no").alias("order_no"), "ledger", "bill", side.alias("side")
    )


@query(
    "join_left_anti",
    """SELECT o_orderkey, o_orderstatus FROM orders o
       WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
)
def join_left_anti(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query(
    "not_in_anti",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def not_in_anti(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rel.not_in(orders, "o_orderkey", table(spark, sf, "lineitem").filter("l_returnflag = 'R'"), "l_orderkey")


@query(
    "in_tuple_semi",
    """SELECT c_nationkey, c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS salary FROM customer
       WHERE (c_nationkey, c_acctbal) IN (SELECT c_nationkey, max(c_acctbal) FROM customer GROUP BY c_nationkey)""",
)
def in_tuple_semi(spark, sf):
    customer = table(spark, sf, "customer")
    best = customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("c_acctbal"))
    return customer.join(best, ["c_nationkey", "c_acctbal"], "left_semi").select(
        "c_nationkey", "c_custkey", cents(F.col("c_acctbal")).alias("salary")
    )


@query(
    "join_using_left",
    """SELECT o.o_custkey AS custkey, o.o_orderkey, c.c_name, c.c_mktsegment
       FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
)
def join_using_left(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return orders.join(customer, ["custkey"], "left")


@query(
    "self_join_day_before",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day,
                    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1, 2)
       SELECT a.event_type, CAST(a.day AS VARCHAR) AS day, a.total, b.total AS previous_value
       FROM d a JOIN d b ON a.event_type = b.event_type AND date_diff('day', b.day, a.day) = 1 WHERE a.total > b.total""",
)
def self_join_day_before(spark, sf):
    daily = (
        table(spark, sf, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.sum(cents(F.col("value"))).alias("total"))
    )
    return rel.rises_from_day_before(daily, ["event_type"], "day", "total").withColumn("day", F.col("day").cast("string"))


@query(
    "correlated_scalar",
    """SELECT e.c_custkey, e.c_name FROM customer e
       WHERE e.c_acctbal > (SELECT m.c_acctbal FROM customer m WHERE m.c_custkey = e.c_custkey // 10)""",
)
def correlated_scalar(spark, sf):
    # the manager of customer k is customer k div 10
    return spark.sql(
        """SELECT e.c_custkey, e.c_name FROM {customer} e
           WHERE e.c_acctbal > (SELECT max(m.c_acctbal) FROM {customer} m WHERE m.c_custkey = e.c_custkey div 10)""",
        customer=table(spark, sf, "customer"),
    )


@query(
    "correlated_top1",
    """SELECT d.p_brand AS dept, d.p_partkey AS member, CAST(round(d.p_retailprice * 100) AS BIGINT) AS top_value
       FROM part d WHERE d.p_retailprice = (SELECT max(s.p_retailprice) FROM part s WHERE s.p_brand = d.p_brand)""",
)
def correlated_top1(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_brand").alias("dept"), F.col("p_partkey").alias("member"), cents(F.col("p_retailprice")).alias("top_value")
    )
    return rel.top1_with_ties(part, "dept", "top_value")


@query(
    "cross_join_scalar",
    "SELECT p_partkey, counts, p_partkey + 1 = counts AS is_last FROM part, (SELECT count(*) AS counts FROM part) t",
)
def cross_join_scalar(spark, sf):
    part = table(spark, sf, "part")
    counted = part.select("p_partkey", part.agg(F.count(F.lit(1))).scalar().alias("counts"))
    return counted.withColumn("is_last", F.col("p_partkey") + 1 == F.col("counts"))


@query(
    "join_left_any_column_differs",
    with_snapshots(
        """SELECT n.* FROM n LEFT JOIN o ON o.account = n.account
           WHERE o.account IS NULL OR n.orders IS DISTINCT FROM o.orders OR n.total IS DISTINCT FROM o.total
              OR n.status IS DISTINCT FROM o.status"""
    ),
)
def join_left_any_column_differs(spark, sf):
    return rel.any_column_differs(account_snapshot(spark, sf, *NEW), account_snapshot(spark, sf, *OLD), "account")


@query(
    "union_distinct",
    """SELECT c_nationkey AS nation, 'balance below 0' AS reason FROM customer WHERE c_acctbal < 0
       UNION SELECT s_nationkey, 'supplier' FROM supplier""",
)
def union_distinct(spark, sf):
    owing = table(spark, sf, "customer").filter("c_acctbal < 0")
    left = owing.select(F.col("c_nationkey").alias("nation"), F.lit("balance below 0").alias("reason"))
    right = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("reason"))
    return left.union(right).distinct()


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS no, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier""",
)
def union_all(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("no"), cents(F.col("c_acctbal")).alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        cents(F.col("s_acctbal")).alias("balance"), F.col("s_suppkey").alias("no"), F.lit("supplier").alias("kind")
    )
    return customers.unionByName(suppliers)


@query(
    "except_distinct",
    """SELECT o_custkey FROM orders EXCEPT
       SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1-%'""",
)
def except_distinct(spark, sf):
    orders = table(spark, sf, "orders")
    flagged = orders.filter("o_orderstatus = 'F' AND o_orderpriority LIKE '1-%'")
    return orders.select("o_custkey").subtract(flagged.select("o_custkey"))


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


@query(
    "order_by_desc",
    """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders
       ORDER BY total DESC, o_orderkey""",
)
def order_by_desc(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", cents(F.col("o_totalprice")).alias("total"))
    return orders.orderBy(F.desc("total"), "o_orderkey")


@query(
    "second_highest",
    """SELECT (SELECT DISTINCT CAST(round(o_totalprice * 100) AS BIGINT) AS t FROM orders
               ORDER BY t DESC LIMIT 1 OFFSET 1) AS second_highest""",
)
def second_highest(spark, sf):
    return rel.second_highest(table(spark, sf, "orders").select(cents(F.col("o_totalprice")).alias("total")), "total")


@query(
    "topk_limit",
    """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders
       ORDER BY total DESC, o_orderkey LIMIT 100""",
)
def topk_limit(spark, sf):
    return order_by_desc(spark, sf).limit(100)
