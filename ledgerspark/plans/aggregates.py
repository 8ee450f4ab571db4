"""Aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import aggregates as agg
from ledgerspark.operators.bitmaps import DistinctByDay
from ledgerspark.plans.registry import query
from ledgerspark.session import cents, new_path, table

PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@query(
    "agg_sum_max_by_key",
    f"""SELECT l_orderkey, CAST(sum({PRICE}) AS BIGINT) AS total, max({PRICE}) AS largest,
          CAST(max(l_shipdate) AS VARCHAR) AS last_ship FROM lineitem GROUP BY l_orderkey""",
)
def agg_sum_max_by_key(spark, sf):
    price = cents(F.col("l_extendedprice"))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(price).alias("total"),
            F.max(price).alias("largest"),
            F.max("l_shipdate").cast("string").alias("last_ship"),
        )
    )


@query(
    "agg_count_distinct",
    """SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_ship
       FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) >= 5""",
)
def agg_count_distinct(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_distinct("l_suppkey").alias("suppliers"),
            F.to_date(F.max("l_shipdate")).cast("string").alias("last_ship"),
        )
        .filter("suppliers >= 5")
    )


DAY_RANGES = (("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-15", "2024-01-31"))


@query(
    "count_distinct_by_days",
    " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS last, event_type, count(DISTINCT user_id) AS users FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{a}' AND DATE '{b}' GROUP BY event_type"
        for a, b in DAY_RANGES
    ),
)
def count_distinct_by_days(spark, sf):
    """Users per type over several ranges of days, all from bitmaps that were made once for each day."""
    events = table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_type", "user_id")
    kept = DistinctByDay(spark, new_path(spark, "bitmaps"), ["event_type"], "user_id")
    kept.load(events)
    ranges = [kept.counts(a, b, "users").select(F.lit(a).alias("first"), F.lit(b).alias("last"), "event_type", "users") for a, b in DAY_RANGES]
    return reduce(DataFrame.unionByName, ranges)


@query("having_duplicates", "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def having_duplicates(spark, sf):
    return table(spark, sf, "documents").groupBy("text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(
    "group_by_case",
    """SELECT 'quantity by return class' AS measure,
         CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'other' END AS bucket,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 2
       UNION ALL
       SELECT 'customers by balance class',
         CASE WHEN c_acctbal <= 500 THEN '1' WHEN c_acctbal <= 600 THEN '2' WHEN c_acctbal <= 800 THEN '3'
              WHEN c_acctbal <= 1000 THEN '4' END, count(*) FROM customer GROUP BY 2""",
)
def group_by_case(spark, sf):
    flag = F.col("l_returnflag")
    by_flag = F.when(flag == "R", "returned").when(flag == "A", "accepted").otherwise("other")
    quantity = (
        table(spark, sf, "lineitem")
        .groupBy(by_flag.alias("bucket"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
        .select(F.lit("quantity by return class").alias("measure"), "bucket", "total")
    )
    bal = F.col("c_acctbal")
    balance_class = F.when(bal <= 500, "1").when(bal <= 600, "2").when(bal <= 800, "3").when(bal <= 1000, "4")
    customers = (
        table(spark, sf, "customer")
        .groupBy(balance_class.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("total"))
        .select(F.lit("customers by balance class").alias("measure"), "bucket", "total")
    )
    return quantity.unionAll(customers)


@query(
    "conditional_sum_pivot",
    """SELECT l_linestatus,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_a,
         CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_n,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS qty_r
       FROM lineitem GROUP BY l_linestatus""",
)
def conditional_sum_pivot(spark, sf):
    qty = F.col("l_quantity").cast("bigint")
    sums = [
        F.sum(F.when(F.col("l_returnflag") == f, qty).otherwise(0)).alias(f"qty_{f.lower()}") for f in ("A", "N", "R")
    ]
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(*sums)


@query(
    "eav_pivot_max_if",
    """SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
         max(CASE WHEN event_type = 'signup' THEN value END) AS signup
       FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY user_id""",
)
def eav_pivot_max_if(spark, sf):
    # one row per (entity, key, value) turned into one column per key
    return (
        table(spark, sf, "events")
        .filter(F.col("event_type").isin("purchase", "signup"))
        .groupBy("user_id")
        .agg(*[F.max(F.when(F.col("event_type") == k, F.col("value"))).alias(k) for k in ("purchase", "signup")])
    )


@query(
    "having_conditional_zero",
    """SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS listed, count(*) AS n
       FROM orders GROUP BY o_custkey
       HAVING sum(CASE WHEN o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%' THEN 1 ELSE 0 END) < 1
          AND o_custkey IS NOT NULL""",
)
def having_conditional_zero(spark, sf):
    priority = F.col("o_orderpriority")
    return agg.groups_without(
        table(spark, sf, "orders"), "o_custkey", priority.like("1-%") | priority.like("2-%"), "o_orderstatus"
    )


@query(
    "group_by_expressions",
    f"""SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_returnflag AS flag, l_linestatus AS status,
         CAST(sum({PRICE}) AS BIGINT) AS total, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def group_by_expressions(spark, sf):
    state = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.to_date("l_shipdate").cast("string").alias("day"), state.alias("state"))
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("total"), F.count(F.lit(1)).alias("n"))
        .select("day", "state.*", "total", "n")
    )


@query(
    "agg_min_max_span_days",
    """SELECT left(account, 3) || '×××' || right(account, 4) AS masked, account, n,
         CAST(min_day AS VARCHAR) AS min_day, CAST(max_day AS VARCHAR) AS max_day,
         CAST(date_diff('day', min_day, max_day) AS INTEGER) AS days
       FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS account, count(o_orderkey) AS n,
               CAST(min(o_orderdate) AS DATE) AS min_day, CAST(max(o_orderdate) AS DATE) AS max_day
             FROM orders GROUP BY 1)""",
)
def agg_min_max_span_days(spark, sf):
    first, last = F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))
    return (
        table(spark, sf, "orders")
        .groupBy(F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("account"))
        .agg(
            F.count("o_orderkey").alias("n"),
            first.cast("string").alias("min_day"),
            last.cast("string").alias("max_day"),
            F.datediff(last, first).alias("days"),
        )
        .withColumn("masked", F.concat(F.left("account", F.lit(3)), F.lit("×××"), F.right("account", F.lit(4))))
    )


@query(
    "agg_by_day_formatted",
    """SELECT strftime(o_orderdate, '%Y年%m月%d日') AS day, count(o_orderkey) AS orders,
         round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100, 2) AS amount
       FROM orders GROUP BY 1 ORDER BY 1 DESC""",
)
def agg_by_day_formatted(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy年MM月dd日").alias("day"))
        .agg(
            F.count("o_orderkey").alias("orders"),
            F.round(F.sum(cents(F.col("o_totalprice"))) / 100, 2).alias("amount"),
        )
        .orderBy(F.desc("day"))
    )


@query(
    "word_count",
    r"""SELECT word, count(*) AS n
        FROM (SELECT unnest(string_split_regex(text, '[ \r\n]')) AS word FROM documents) WHERE word <> '' GROUP BY word""",
)
def word_count(spark, sf):
    return agg.word_count(table(spark, sf, "documents"), "text")


@query(
    "flow_sum",
    """SELECT CAST(user_id AS VARCHAR) AS phone, CAST(sum(up) AS BIGINT) AS up, CAST(sum(down) AS BIGINT) AS down,
         CAST(sum(up + down) AS BIGINT) AS total
       FROM (SELECT user_id, CAST(round(value * 100) AS BIGINT) AS up,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS down FROM events) GROUP BY user_id""",
)
def flow_sum(spark, sf):
    line = F.concat_ws(
        "\t", "event_id", "user_id", "ts", "event_type", cents(F.col("value")), F.get_json_object("props", "$.k"), F.lit("200")
    )
    return agg.flow_sum(table(spark, sf, "events").select(line.alias("value")))


@query(
    "reduce_fold",
    """SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total,
         CAST(2 * product(l_linenumber) AS BIGINT) AS seeded_product FROM lineitem GROUP BY l_orderkey""",
)
def reduce_fold(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_quantity").cast("int").cast("bigint")).alias("total"),
            (2 * F.product("l_linenumber")).cast("bigint").alias("seeded_product"),
        )
    )


@query(
    "agg_last_ordered",
    """SELECT user_id, arg_max(CAST(round(value * 100) AS BIGINT), (ts, event_id)) AS last_amount
       FROM events GROUP BY user_id""",
)
def agg_last_ordered(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(F.max_by(cents(F.col("value")), F.struct("ts", "event_id")).alias("last_amount"))
    )


@query(
    "multiset_multimap_agg",
    """SELECT p_brand, string_agg(p_type || ':' || n, ',' ORDER BY p_type) AS entries, count(*) AS kinds,
         CAST(coalesce(max(CASE WHEN p_type = 'PROMO' THEN n END), 0) AS BIGINT) AS promo,
         CAST(coalesce(max(CASE WHEN p_type = 'SMALL' THEN n END), 0) AS BIGINT) AS small
       FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY p_brand""",
)
def multiset_multimap_agg(spark, sf):
    # counted per (key, value) first: the list of a key is as long as the type domain, not its rows
    parts = table(spark, sf, "part")
    kind = agg.from_small_domain(parts, "p_type", 1000).alias("p_type")
    counted = parts.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).select("p_brand", kind, "n")
    cell = {c: F.coalesce(F.max(F.when(F.col("p_type") == c.upper(), F.col("n"))), F.lit(0)) for c in ("promo", "small")}
    entries = F.transform(F.array_sort(F.collect_list(F.struct("p_type", "n"))), lambda e: F.concat_ws(":", e.p_type, e.n))
    return counted.groupBy("p_brand").agg(
        F.array_join(entries, ",").alias("entries"),
        F.count(F.lit(1)).alias("kinds"),
        *[c.alias(name) for name, c in cell.items()],
    )


@query(
    "string_join_agg",
    """SELECT user_id, (rn - 1) // 1000 AS part, string_agg(event_type, ',' ORDER BY rn) AS joined
       FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       GROUP BY 1, 2""",
)
def string_join_agg(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return agg.string_join(events, ["user_id"], ["ts", "event_id"], "event_type", per_row=1000)


@query(
    "any_match",
    """SELECT o_custkey, bool_or(o_orderstatus = 'F' AND o_totalprice > 400000) AS has_large_closed
       FROM orders GROUP BY o_custkey""",
)
def any_match(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.bool_or((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).alias("has_large_closed"))
    )
