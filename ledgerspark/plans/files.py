"""Sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.plans.registry import query
from ledgerspark.plans.snapshots import NEW, OLD, UNKNOWN, account_snapshot, snapshot_sql, with_compared, with_snapshots
from ledgerspark.session import cents, new_path, table
from ledgerspark.sources import files as fl
from ledgerspark.sources.jdbc import scan_jdbc, write_jdbc
from ledgerspark.sources.partitions import replace_by_key
from ledgerspark.sources.versions import VersionedTable
from ledgerspark.operators import sync

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders"


def order_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", cents(F.col("o_totalprice")).alias("total"))


@query("scan_parquet", ORDERS_SQL)
def scan_parquet(spark, sf):
    path = new_path(spark, "parquet")
    order_rows(spark, sf).write.parquet(path)
    return spark.read.load(path)


@query("scan_json", ORDERS_SQL)
def scan_json(spark, sf):
    path = new_path(spark, "json")
    order_rows(spark, sf).write.json(path)
    return fl.scan_json(spark, path)


@query(
    "json_strings_to_table",
    """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE event_id % 2 WHEN 0 THEN event_id ELSE event_id + 0.5e0 END AS number,
         CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS mixed, CAST(NULL AS VARCHAR) AS never FROM events""",
)
def json_strings_to_table(spark, sf):
    # whole numbers and halves, numbers and texts, and a field that is only ever null
    number = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.concat("event_id", F.lit(".5")))
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    document = F.concat(
        F.regexp_replace("props", r"\}\s*$", ""), F.lit(',"number":'), number, F.lit(',"mixed":'), mixed, F.lit(',"never":null}')
    )
    events = table(spark, sf, "events").select(document.alias("document"))
    found = fl.json_strings_to_table(events, "document")
    return found.select(F.col("k").cast("bigint").alias("k"), "number", "mixed", "never")


@query("scan_text_split", "SELECT c_name AS name, CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS no, CAST(c_acctbal AS DOUBLE) AS balance FROM customer")
def scan_text_split(spark, sf):
    path = new_path(spark, "text")
    no = F.when(F.col("c_nationkey") == 0, "n/a").otherwise(F.col("c_custkey").cast("string"))
    line = F.concat_ws(" , ", "c_name", no, F.col("c_acctbal").cast("string"))
    table(spark, sf, "customer").select(line.alias("value")).write.text(path)
    return fl.scan_text_split(spark, path, T.StructType().add("name", "string").add("no", "long").add("balance", "double"))


@query(
    "scan_csv_options",
    """SELECT o_orderkey AS no, CASE o_orderstatus WHEN 'F' THEN '交易' ELSE '退款' END AS kind, o_orderpriority AS note FROM orders""",
)
def scan_csv_options(spark, sf):
    path = new_path(spark, "csv")
    kind = F.when(F.col("o_orderstatus") == "F", "交易").otherwise("退款")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("no"), kind.alias("kind"), F.col("o_orderpriority").alias("note"))
    options = dict(sep=";", header=True, encoding="GB2312")
    fl.write_csv(rows.filter("kind = '交易'"), f"{path}/2020/trade", **options)
    fl.write_csv(rows.filter("kind <> '交易'"), f"{path}/2021/refund", **options)
    return fl.scan_csv(spark, f"{path}/*/*", comment="#", inferSchema=True, **options).withColumn("no", F.col("no").cast("bigint"))


@query("scan_orc", "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders WHERE o_custkey = 7")
def scan_orc(spark, sf):
    path = new_path(spark, "orc")
    fl.write_orc(order_rows(spark, sf), path, bloom="o_custkey", dictionary="o_orderkey")
    return spark.read.orc(path).filter("o_custkey = 7")


def jdbc_url(spark) -> str:
    """The database that the session names; a local session falls back to one inside its own process.

    ``local-cluster`` is none: its executors are processes of their own, and each would see an empty database.
    """
    url = spark.conf.get("spark.ledgerspark.jdbc.url", None)
    if url:
        return url
    if spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise RuntimeError("set spark.ledgerspark.jdbc.url to a database that all executors reach")
    return f"jdbc:derby:memory:ledger{uuid.uuid4().hex};create=true"


@query("scan_jdbc", "SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer")
def scan_jdbc_query(spark, sf):
    url, name = jdbc_url(spark), f"customer_{uuid.uuid4().hex}"
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", cents(F.col("c_acctbal")).alias("balance"))
    write_jdbc(rows, url, name)
    ends = rows.agg(F.min("c_custkey").alias("lower"), F.max("c_custkey").alias("upper")).first().asDict()
    split = {} if ends["upper"] is None else {"split_on": "c_custkey", **ends}  # without a key there are no ranges
    back = scan_jdbc(spark, url, name, **split)
    return back.select(*[F.col(c).alias(c.lower()) for c in back.columns])


@query("sql_on_file", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def sql_on_file(spark, sf):
    picked = fl.sql_on_file(spark, f"{sf}/orders.parquet", "o_orderstatus", "o_totalprice > 100000")
    return picked.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "range_source",
    """SELECT k AS id FROM (SELECT unnest(range(0, (SELECT max(l_orderkey) + 1 FROM lineitem))) AS k)
       WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def range_source(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    upper = lines.agg(F.max("l_orderkey")).first()[0]
    return spark.range(upper + 1).join(lines, F.col("id") == F.col("l_orderkey"), "left_anti")


@query(
    "local_rows_to_table",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END AS name, count(*) AS n FROM orders GROUP BY 1""",
)
def local_rows_to_table(spark, sf):
    names = fl.local_rows_to_table(spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "code string, name string")
    counted = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(names, "code").select("name", "n")


def two_versions(spark, sf) -> VersionedTable:
    versions = VersionedTable(spark, new_path(spark, "versions"), part="status")
    versions.write(account_snapshot(spark, sf, *OLD))
    versions.write(account_snapshot(spark, sf, *NEW))
    return versions


@query("versioned_read", snapshot_sql(*NEW))
def versioned_read(spark, sf):
    return two_versions(spark, sf).read()


@query("time_travel_read", snapshot_sql(*OLD))
def time_travel_read(spark, sf):
    return two_versions(spark, sf).read(version=0)


@query("full_overwrite_snapshot", with_snapshots("SELECT account, total FROM n UNION ALL SELECT -1 - account, total FROM o"))
def full_overwrite_snapshot(spark, sf):
    versions = VersionedTable(spark, new_path(spark, "whole"))
    versions.write(account_snapshot(spark, sf, *OLD))
    versions.write(account_snapshot(spark, sf, *NEW))
    latest, first = versions.read(), versions.read(version=0)
    # the new version is derived from the two before it
    versions.write(latest.select("account", "total").unionAll(first.select(-1 - F.col("account"), "total")))
    return versions.read()


@query("update_where", with_snapshots("SELECT account, orders, CASE WHEN status = 'F' THEN total + 100 ELSE total END AS total, status FROM n"))
def update_where(spark, sf):
    versions = two_versions(spark, sf)
    versions.update(F.col("status") == "F", total=F.col("total") + 100)
    return versions.read()


@query("update_swap_values", "SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 'O' ELSE 'F' END AS l_linestatus FROM lineitem")
def update_swap_values(spark, sf):
    status = F.col("l_linestatus")
    swapped = F.when(status == "F", "O").when(status == "O", "F").otherwise(status)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", swapped.alias("l_linestatus"))


@query("delete_where", with_snapshots("SELECT * FROM n WHERE NOT (status = 'F' AND total > 20000000)"))
def delete_where(spark, sf):
    versions = two_versions(spark, sf)
    versions.delete((F.col("status") == "F") & (F.col("total") > 20000000))
    return versions.read()


@query("delete_duplicates_keep_min", "SELECT min(doc_id) AS doc_id, text, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text")
def delete_duplicates_keep_min(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return fl.keep_min_per_key(docs, "doc_id", "text")


@query(
    "merge_upsert",
    with_snapshots(
        """SELECT coalesce(o.account, n.account) AS account, CASE WHEN o.account IS NULL THEN n.orders ELSE o.orders END AS orders,
             coalesce(n.total, o.total) AS total, CASE WHEN o.account IS NULL THEN n.status ELSE o.status END AS status
           FROM o FULL JOIN n ON o.account = n.account"""
    ),
)
def merge_upsert(spark, sf):
    versions = VersionedTable(spark, new_path(spark, "versions"), part="status")
    versions.write(account_snapshot(spark, sf, *OLD))
    # only the total of a matched account is updated
    versions.merge(account_snapshot(spark, sf, *NEW), ["account"], ["total"])
    return versions.read()


@query(
    "replace_where",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type, event_id FROM events
       WHERE ts < TIMESTAMP '2024-01-20' OR event_type <> 'error' AND ts < TIMESTAMP '2024-01-25'""",
)
def replace_where_query(spark, sf):
    versions = VersionedTable(spark, new_path(spark, "replaced"), part="date")
    events = table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_type", "event_id")
    versions.write(events)
    # from the 20th on only other types up to the 24th come back: later days must be gone
    fresh = events.filter("date >= date '2024-01-20' AND date < date '2024-01-25' AND event_type <> 'error'")
    versions.replace_where(fresh, F.col("date") >= F.lit("2024-01-20").cast("date"))
    return versions.read().select(F.col("date").cast("string").alias("date"), "event_type", "event_id")


@query(
    "replace_by_key",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN CAST(round(o_totalprice * 100) AS BIGINT) + 1
         ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS total, o_orderstatus FROM orders""",
)
def replace_by_key_query(spark, sf):
    path = new_path(spark, "keyed")
    rows = order_rows(spark, sf).select("o_orderkey", "o_custkey", "total", "o_orderstatus")
    fl.write_partitioned(rows, path, "o_orderstatus")
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select("o_orderkey")
    changed = rows.join(urgent, "o_orderkey", "left_semi").withColumn("total", F.col("total") + 1)
    replace_by_key(changed.select(*rows.columns), path, ["o_orderkey"], "o_orderstatus")
    return spark.read.parquet(path).select(*rows.columns)


@query("write_modes", f"SELECT fmt, o.* FROM ({ORDERS_SQL}) o, (SELECT unnest(['csv', 'orc', 'parquet']) AS fmt)")
def write_modes(spark, sf):
    rows = order_rows(spark, sf)
    read = []
    for fmt in ("csv", "orc", "parquet"):
        path = new_path(spark, f"modes-{fmt}")
        rows.withColumn("total", F.lit(0).cast("bigint")).write.format(fmt).save(path)
        even = F.col("o_orderkey") % 2 == 0
        rows.filter(even).write.format(fmt).mode("overwrite").save(path)
        rows.filter(~even).write.format(fmt).mode("append").save(path)
        # the table exists, so this one changes nothing
        rows.limit(0).write.format(fmt).mode("ignore").save(path)
        read.append(spark.read.schema(rows.schema).format(fmt).load(path).select(F.lit(fmt).alias("fmt"), "*"))
    return read[0].unionAll(read[1]).unionAll(read[2])


@query("write_partitioned", "SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS total, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def write_partitioned_query(spark, sf):
    path = new_path(spark, "partitioned")
    fl.write_partitioned(order_rows(spark, sf), path, "o_orderstatus")
    return spark.read.parquet(path).filter("o_orderstatus = 'O'")


@query(
    "write_bucketed",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def write_bucketed_query(spark, sf):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = fl.write_bucketed(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", buckets, ["o_orderstatus"])
    # one row per order, so that no bucket holds a hot key when the tables are joined
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("l_extendedprice"))).alias("price")
    )
    lines = fl.write_bucketed(per_order, "l_orderkey", buckets)
    joined = spark.table(lines).join(spark.table(orders), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), F.sum("price").alias("total"))


@query("create_table_as", "SELECT c_name, c_mktsegment FROM customer")
def create_table_as_query(spark, sf):
    name = fl.create_table_as(spark, table(spark, sf, "customer").select("c_name", "c_mktsegment"))
    like = fl.create_table_like(spark, name)
    # the copy of the structure is empty
    return spark.table(name).unionByName(spark.table(like))


@query("create_view_renamed", "SELECT s_name AS first_name_v, s_nationkey AS last_name_v FROM supplier")
def create_view_renamed(spark, sf):
    renamed = table(spark, sf, "supplier").select(F.col("s_name").alias("first_name_v"), F.col("s_nationkey").alias("last_name_v"))
    renamed.createOrReplaceTempView("renamed_suppliers")
    return spark.table("renamed_suppliers")


@query("audit_on_insert", "SELECT c_custkey AS emp_no, c_name AS name FROM customer")
def audit_on_insert(spark, sf):
    path, audit = new_path(spark, "employees"), new_path(spark, "audit")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    fl.insert_with_audit(customers.filter("c_acctbal >= 0"), path, audit, "c_custkey", "c_name")
    fl.insert_with_audit(customers.filter("c_acctbal < 0"), path, audit, "c_custkey", "c_name")
    return spark.read.parquet(audit)


@query(
    "partition_sink_with_counters",
    with_compared(
        "SELECT replace(change, 'status', 'update') AS change, count(*) AS n FROM both_sides WHERE change IS NOT NULL GROUP BY 1"
    ),
)
def partition_sink_with_counters(spark, sf):
    old, new = account_snapshot(spark, sf, *OLD, UNKNOWN), account_snapshot(spark, sf, *NEW, UNKNOWN)
    changes = sync.sync_by_key(new, old, "account").select("account", "source", "change")
    return fl.write_classes(changes, new_path(spark, "classes"), "change")
