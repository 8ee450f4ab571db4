"""Row-level functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import scalars as sc
from ledgerspark.operators.apportion import round_half_up
from ledgerspark.operators.reconcile import text_cents, unmarked
from ledgerspark.plans.registry import query
from ledgerspark.plans.snapshots import NEW, OLD, account_snapshot, with_snapshots
from ledgerspark.session import cents, table


@query(
    "scalar_conditional",
    """SELECT d.doc_id, CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' ELSE 'unknown' END AS simple_case,
         CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'clean' ELSE 'other' END AS searched_case,
         CASE WHEN d.n_chars > 1000 THEN 'long' ELSE 'short' END AS if_value, coalesce(l.quality, -1) AS if_null,
         l.quality IS NULL AS is_null, coalesce(l.toxic, l.quality, 9) AS first_non_null
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def scalar_conditional(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").selectExpr(
        "doc_id",
        "CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' ELSE 'unknown' END AS simple_case",
        "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' ELSE 'other' END AS searched_case",
        "if(n_chars > 1000, 'long', 'short') AS if_value",
        "ifnull(quality, -1) AS if_null",
        "isnull(quality) AS is_null",
        "coalesce(toxic, quality, 9) AS first_non_null",
    )


@query(
    "scalar_money_parse",
    """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(floor(o_totalprice) AS BIGINT) AS whole,
         CAST(sign(250000 - o_totalprice) AS INTEGER) AS side, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS maybe
       FROM orders""",
)
def scalar_money_parse(spark, sf):
    price = F.col("o_totalprice")
    text = F.concat(F.lit("`"), price.cast("decimal(14,2)").cast("string"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", price, text.alias("marked"),
        F.when(F.col("o_orderstatus") == "P", F.lit("`--")).otherwise(text).alias("maybe_marked"),
    )
    return rows.select(
        "o_orderkey",
        text_cents(unmarked("marked")).alias("cents"),
        F.floor(price).alias("whole"),
        F.signum(250000 - price).cast("int").alias("side"),
        text_cents(unmarked("maybe_marked")).alias("maybe"),
    )


@query(
    "scalar_string",
    """SELECT c_custkey, substring(c_name, 1, 8) AS head, replace(c_name, '#', '-') AS replaced, left(c_name, 4) AS l,
         right(c_name, 4) AS r, concat_ws('/', c_name, c_mktsegment) AS joined, c_mktsegment LIKE '%U%' AS has_u,
         lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded FROM customer""",
)
def scalar_string(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "substring(c_name, 1, 8) AS head", "replace(c_name, '#', '-') AS replaced", "left(c_name, 4) AS l",
        "right(c_name, 4) AS r", "concat_ws('/', c_name, c_mktsegment) AS joined", "c_mktsegment LIKE '%U%' AS has_u",
        "format_string('%03d', c_nationkey) AS padded",
    )


@query(
    "scalar_regex",
    r"""SELECT doc_id, CAST(len(regexp_split_to_array(text, '[\r\n]+')) AS INTEGER) AS lines,
          regexp_replace('3.02' || lang || 'cost-' || source, '^\d+\.\d+([^\-]+)\-(.*)', '\1.\2') AS title,
          regexp_matches('2020-08-01至2021-07-31优惠' || n_chars || '.00元。', '^(\d{4}-\d{2}-\d{2})至(\d{4}-\d{2}-\d{2})优惠([\d\.]+)元.*$') AS is_discount,
          regexp_extract('2020-08-01至2021-07-31优惠' || n_chars || '.00元。', '^(\d{4}-\d{2}-\d{2})至(\d{4}-\d{2}-\d{2})优惠([\d\.]+)元.*$', 3) AS discount,
          regexp_replace(text, '[^0-9]', '', 'g') AS digits, length(regexp_replace(text, '[0-9]', '', 'g')) AS other_chars
        FROM documents""",
)
def scalar_regex(spark, sf):
    account = F.concat(F.lit("3.02"), "lang", F.lit("cost-"), "source")
    note = F.concat(F.lit("2020-08-01至2021-07-31优惠"), F.col("n_chars").cast("string"), F.lit(".00元。"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(F.split("text", r"[\r\n]+")).alias("lines"),
        F.regexp_replace(account, sc.TITLE, "$1.$2").alias("title"),
        note.rlike(sc.DISCOUNT).alias("is_discount"),
        F.regexp_extract(note, sc.DISCOUNT, 3).alias("discount"),
        F.regexp_replace("text", "[^0-9]", "").alias("digits"),
        F.length(F.regexp_replace("text", "[0-9]", "")).cast("bigint").alias("other_chars"),
    )


@query(
    "scalar_split_trim_omit",
    r"""SELECT doc_id, CAST(len(parts) AS INTEGER) AS n, array_to_string(parts, '|') AS joined FROM (
          SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS parts
          FROM documents)""",
)
def scalar_split_trim_omit(spark, sf):
    parts = table(spark, sf, "documents").select("doc_id", sc.split_trim_omit(F.col("text")).alias("parts"))
    return parts.select("doc_id", F.size("parts").alias("n"), F.array_join("parts", "|").alias("joined"))


@query(
    "text_split_keep_delimiter",
    """SELECT doc_id, CAST(len(parts) AS INTEGER) AS n, array_to_string(parts, '|') AS joined FROM (
         SELECT doc_id, string_split(regexp_replace(text, '([.!?])', '\\1' || chr(2), 'g'), chr(2)) AS parts FROM documents)""",
)
def text_split_keep_delimiter(spark, sf):
    parts = sc.split_keep_delimiter(F.col("text"), "[.!?]")
    docs = table(spark, sf, "documents").select("doc_id", parts.alias("parts"))
    return docs.select("doc_id", F.size("parts").alias("n"), F.array_join("parts", "|").alias("joined"))


@query(
    "text_extract_clauses",
    """WITH c AS (SELECT o_orderkey, 'priority' || o_orderpriority AS head, strftime(o_orderdate, '%Y-%m-%d') AS d1,
            o_orderkey || '.00' AS a1, strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%d') AS d2, o_custkey || '.50' AS a2 FROM orders),
          t AS (SELECT *, head || '截止' || d1 || '，每年费用' || a1 || '元。（a=1）' || chr(10) || 'part' AS before FROM c)
       SELECT o_orderkey, length(head) AS offset, d1 AS date, a1 AS amount FROM t
       UNION ALL SELECT o_orderkey, length(before), d2, a2 FROM t""",
)
def text_extract_clauses(spark, sf):
    """A contract text per order with two yearly-cost clauses on lines of their own."""

    def clause(day, amount):
        return F.concat(F.lit("截止"), F.date_format(day, "yyyy-MM-dd"), F.lit("，每年费用"), amount, F.lit("元。（a=1）"))

    first = clause("o_orderdate", F.concat(F.col("o_orderkey").cast("string"), F.lit(".00")))
    second = clause(F.expr("o_orderdate + interval 1 year"), F.concat(F.col("o_custkey").cast("string"), F.lit(".50")))
    text = F.concat(F.lit("priority"), "o_orderpriority", first, F.lit("\npart"), second)
    texts = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return sc.extract_clauses(texts, "text", "o_orderkey").withColumn("offset", F.col("offset").cast("bigint"))


@query(
    "scalar_datetime",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS formatted, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
         CAST(epoch(o_orderdate) AS BIGINT) AS seconds, CAST(o_orderdate + INTERVAL 90 MINUTE AS VARCHAR) AS later,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
         CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS week_before, CAST(NULL AS VARCHAR) AS not_a_time FROM orders""",
)
def scalar_datetime(spark, sf):
    day = F.to_date("o_orderdate")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    # text to time and back through epoch seconds
    parsed = F.try_to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss"))
    later = F.from_unixtime(F.unix_timestamp(parsed) + 90 * 60)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("formatted"),
        day.cast("string").alias("day"),
        seconds.alias("seconds"),
        later.alias("later"),
        F.datediff(day, F.lit("1995-01-01")).alias("days"),
        F.date_sub(day, 7).cast("string").alias("week_before"),
        F.try_to_timestamp("o_orderpriority", F.lit("yyyy-MM-dd")).cast("string").alias("not_a_time"),
    )


@query(
    "scalar_math",
    """SELECT event_id, CAST(floor(value) AS BIGINT) AS floored, CAST(floor(value - 100 + 0.5e0) AS BIGINT) AS half_up,
         CAST(round(value * 100) AS BIGINT) % 7 AS modulo, CAST(sign(value - 50) AS INTEGER) AS side,
         least(value, 10e0) AS smaller, greatest(value, 10e0) AS larger, abs(value - 50) AS distance FROM events""",
)
def scalar_math(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        F.floor(v).alias("floored"),
        round_half_up(v - 100).alias("half_up"),
        (cents(v) % 7).alias("modulo"),
        F.signum(v - 50).cast("int").alias("side"),
        F.least(v, F.lit(10.0)).alias("smaller"),
        F.greatest(v, F.lit(10.0)).alias("larger"),
        F.abs(v - 50).alias("distance"),
    )


@query(
    "scalar_bitwise",
    """SELECT event_id, event_id >> 2 AS quarter, event_id << 2 AS four_times, event_id % 2 = 1 AS odd, -event_id AS negated,
         abs(event_id - 5000) AS distance, xor(event_id, user_id) AS mixed, event_id & user_id AS common FROM events""",
)
def scalar_bitwise(spark, sf):
    n = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.shiftright(n, 2).alias("quarter"),
        F.shiftleft(n, 2).alias("four_times"),
        sc.is_odd(n).alias("odd"),
        sc.negate_by_bits(n).alias("negated"),
        sc.abs_by_bits(n - 5000).alias("distance"),
        n.bitwiseXOR(F.col("user_id")).alias("mixed"),
        n.bitwiseAND(F.col("user_id")).alias("common"),
    )


@query(
    "array_functions",
    """WITH a AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 100) AS INTEGER)) AS v FROM embeddings)
       SELECT vec_id, CAST(len(list_filter(v, lambda x: x > 0)) AS INTEGER) AS positives, CAST(list_sum(v) AS BIGINT) AS total,
         array_to_string(list_sort(v), ',') AS sorted, CAST(len(list_distinct(v)) AS INTEGER) AS kinds, list_min(v) AS smallest, list_max(v) AS largest,
         list_contains(v, 0) AS has_zero, CAST(len(list_concat(v, v)) AS INTEGER) AS doubled,
         array_to_string(flatten(list_transform(v, lambda x: [x, -x])), ',') AS mirrored FROM a""",
)
def array_functions(spark, sf):
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100).cast("int"))
    a = table(spark, sf, "embeddings").select("vec_id", v.alias("v"))
    return a.select(
        "vec_id",
        F.size(F.filter("v", lambda x: x > 0)).alias("positives"),
        F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"),
        F.array_join(F.array_sort("v"), ",").alias("sorted"),
        F.size(F.array_distinct("v")).alias("kinds"),
        F.array_min("v").alias("smallest"),
        F.array_max("v").alias("largest"),
        F.array_contains("v", 0).alias("has_zero"),
        F.size(F.concat("v", "v")).alias("doubled"),
        F.array_join(F.flatten(F.transform("v", lambda x: F.array(x, -x))), ",").alias("mirrored"),
    )


@query(
    "explode_array",
    """SELECT vec_id, flag, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS pos,
         CAST(floor(CAST(unnest(embedding) AS DOUBLE) * 1000) AS BIGINT) AS v
       FROM embeddings, (SELECT unnest([0, 1]) AS flag)""",
)
def explode_array(spark, sf):
    flagged = table(spark, sf, "embeddings").withColumn("flag", F.explode(F.array(F.lit(0), F.lit(1))))
    items = flagged.select("vec_id", "flag", F.posexplode("embedding").alias("pos", "x"))
    return items.select("vec_id", "flag", "pos", F.floor(F.col("x").cast("double") * 1000).alias("v"))


@query(
    "struct_functions",
    with_snapshots(
        """SELECT n.account AS new_account, o.account AS old_account, n.total AS new_total FROM n FULL JOIN o ON n.account = o.account
           WHERE n.account IS NULL OR o.account IS NULL OR (n.orders, n.total, n.status) IS DISTINCT FROM (o.orders, o.total, o.status)"""
    ),
)
def struct_functions(spark, sf):
    n, o = account_snapshot(spark, sf, *NEW).alias("n"), account_snapshot(spark, sf, *OLD).alias("o")
    joined = n.join(o, F.col("n.account") == F.col("o.account"), "full")
    pairs = joined.selectExpr("struct(n.*) AS a", "struct(o.*) AS b").filter("a != b")
    return pairs.select(
        F.col("a.account").alias("new_account"), F.col("b.account").alias("old_account"), F.col("a.total").alias("new_total")
    )


@query(
    "json_point_at",
    """SELECT event_id, json_extract_string(props, '/k') AS k, event_type AS first_value, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def json_point_at(spark, sf):
    listed = F.to_json(F.array(F.struct(F.col("event_type").alias("value"), F.struct("user_id").alias("who"))))
    return table(spark, sf, "events").select(
        "event_id",
        sc.json_point_at(F.col("props"), "/k").alias("k"),
        sc.json_point_at(listed, "/0/value").alias("first_value"),
        sc.json_point_at(listed, "/1/value").alias("absent"),
    )


@query(
    "snowflake_ids",
    f"""WITH b AS (SELECT event_id, user_id % 32 AS worker, (user_id // 32) % 32 AS dc, (epoch_us(ts) // 1000 - {sc.ID_EPOCH_MS}) * 4096 AS f FROM events),
         r AS (SELECT *, row_number() OVER (PARTITION BY dc, worker ORDER BY f, event_id) AS rn FROM b),
         m AS (SELECT *, max(f - rn) OVER (PARTITION BY dc, worker ORDER BY f, event_id) + rn AS slot FROM r)
       SELECT event_id, CAST((slot // 4096) * 4194304 + dc * 131072 + worker * 4096 + slot % 4096 AS BIGINT) AS id FROM m""",
)
def snowflake_ids(spark, sf):
    user = F.col("user_id")
    events = table(spark, sf, "events").select(
        "event_id", "ts", (user % 32).alias("worker"), (F.floor(user / 32) % 32).alias("dc")
    )
    return sc.snowflake_ids(events, "ts", "worker", "dc", "event_id").select("event_id", "id")


@query("row_ids", "SELECT count(*) AS rows_numbered, true AS all_distinct FROM events")
def row_ids(spark, sf):
    numbered = table(spark, sf, "events").select(F.monotonically_increasing_id().alias("id"))
    per_id = numbered.groupBy("id").count()
    return per_id.agg(F.sum("count").alias("rows_numbered"), (F.max("count") == 1).alias("all_distinct"))


@query(
    "code_lookup",
    """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN '省' WHEN '2' THEN '市' WHEN '3' THEN '县' WHEN '4' THEN '乡镇' WHEN '5' THEN '村庄' END AS region,
         CASE WHEN o_orderkey % 9 IN (1, 3) THEN '空闲' WHEN o_orderkey % 9 = 4 THEN '故障' WHEN o_orderkey % 9 = 5 THEN '游离'
              WHEN o_orderkey % 9 = 6 THEN '掉线' WHEN o_orderkey % 9 = 7 THEN '维护' WHEN o_orderkey % 9 = 8 THEN '上线' END AS status FROM orders""",
)
def code_lookup(spark, sf):
    region = sc.lookup(sc.REGION_TYPES, F.left("o_orderpriority", F.lit(1)).cast("int"))
    status = sc.normal_status(sc.lookup(sc.DEVICE_STATUS, (F.col("o_orderkey") % 9).cast("int")))
    return table(spark, sf, "orders").select("o_orderkey", region.alias("region"), status.alias("status"))
