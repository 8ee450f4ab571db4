"""Snapshot comparison and synchronisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import sync
from ledgerspark.plans.registry import query
from ledgerspark.plans.snapshots import NEW, OLD, UNKNOWN, account_snapshot, with_compared
from ledgerspark.session import new_path, parts_of, stored, table
from ledgerspark.sources.digests import Snapshot, compared


def old_and_new(spark, sf):
    return account_snapshot(spark, sf, *OLD, UNKNOWN), account_snapshot(spark, sf, *NEW, UNKNOWN)


@query(
    "sync_by_key",
    with_compared("SELECT account, change, orders, total FROM both_sides WHERE change <> 'status'"),
)
def sync_by_key(spark, sf):
    old, new = old_and_new(spark, sf)
    # the target also has a status, which the source does not know
    changes = sync.sync_by_key(new.drop("status"), old, "account")
    return changes.select("account", "change", "source.orders", "source.total")


@query(
    "sync_by_digest",
    with_compared("SELECT account, change, orders, total FROM both_sides WHERE change <> 'status'"),
)
def sync_by_digest(spark, sf):
    """The changes of ``sync_by_key`` from stored copies of both sides, reading the buckets that differ only."""
    old, new = old_and_new(spark, sf)
    kept = [Snapshot(spark, new_path(spark, "copy"), "account", buckets=32).write(side.drop("status")) for side in (new, old)]
    return compared(*kept, sync.sync_by_key).select("account", "change", "source.orders", "source.total")


@query(
    "snapshot_changes_by_digest",
    with_compared(
        """SELECT account, orders, total, status, CASE change WHEN 'status' THEN 'update' ELSE change END AS change_type
           FROM both_sides WHERE change IS NOT NULL"""
    ),
)
def snapshot_changes_by_digest(spark, sf):
    """What changed between two stored snapshots: the rows that ``snapshot_diff`` gives flag 1."""
    old, new = old_and_new(spark, sf)
    kept = [Snapshot(spark, new_path(spark, "snapshot"), "account", buckets=32).write(side) for side in (new, old)]
    return compared(*kept, lambda n, o, key: sync.snapshot_diff(o, n, key)).filter("flag = 1").drop("flag")


@query(
    "snapshot_diff",
    with_compared(
        """SELECT account, orders, total, status, 0 AS flag, CAST(NULL AS VARCHAR) AS change_type FROM both_sides WHERE in_new
           UNION ALL
           SELECT account, orders, total, status, 1, CASE change WHEN 'status' THEN 'update' ELSE change END
           FROM both_sides WHERE change IS NOT NULL"""
    ),
)
def snapshot_diff(spark, sf):
    old, new = old_and_new(spark, sf)
    return sync.snapshot_diff(old, new, "account")


@query(
    "snapshot_enrich_missing",
    """WITH cur AS (SELECT o_orderkey AS device, CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS status, o_custkey FROM orders),
         known AS (SELECT l_orderkey AS device, max(l_returnflag) AS model FROM lineitem GROUP BY 1)
       SELECT cur.device, cur.status, coalesce(known.model, c.c_mktsegment) AS model
       FROM cur LEFT JOIN known ON known.device = cur.device LEFT JOIN customer c ON c.c_custkey = cur.o_custkey""",
)
def snapshot_enrich_missing(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("device"), F.col("o_orderstatus").alias("status"), "o_custkey")
    pages = [orders.filter(F.col("status") == s) for s in ("O", "P", "F")]
    current = pages[0].unionAll(pages[1]).unionAll(pages[2])
    current = current.withColumn("status", F.when(F.col("status") == "P", "O").otherwise(F.col("status")))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("device"), F.col("l_returnflag").alias("model"))
    # sorts of a task hold its part, so parts follow the rows; known models are sorted once, and read from there
    parts = parts_of(lines)
    # written once, else the search for missing models is made on each page; known models are as many, so no join sends them out whole
    current = stored(current, "current").repartition(parts, "device")
    known = stored(lines.repartition(parts, "device").groupBy("device").agg(F.max("model").alias("model")), "known").repartition(parts, "device")
    # devices without a known model are looked up one by one elsewhere; here by their customer
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("model"))
    missing = sync.missing_keys(current, known.hint("merge"), "device")
    filled = missing.join(current, "device").join(customer, "o_custkey").select("device", "model")
    return sync.enrich(current.drop("o_custkey"), known, filled, "device", parts)


def kept_and_online(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("app_id"), F.col("o_custkey").alias("apply_id"), F.col("o_orderkey").alias("log_id"),
        F.col("o_orderdate").alias("update_time"),
    )
    kept = rows.filter("update_time < timestamp_ntz '1998-01-01'")
    online = rows.filter("update_time >= timestamp_ntz '1996-01-01' AND update_time < timestamp_ntz '2000-01-01'")
    return kept, online


KEPT = """kept AS (SELECT o_orderpriority AS app_id, o_custkey AS apply_id, o_orderkey AS log_id, o_orderdate AS update_time
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
  online AS (SELECT o_orderpriority AS app_id, o_custkey AS apply_id, o_orderkey AS log_id, o_orderdate AS update_time
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01')"""


@query(
    "sync_count_guard",
    f"""WITH {KEPT}, k AS (SELECT DISTINCT app_id, apply_id FROM kept), n AS (SELECT DISTINCT app_id, apply_id FROM online)
        SELECT coalesce(k.app_id, n.app_id) AS app_id, count(k.apply_id) AS kept,
          CAST(sum(CASE WHEN k.apply_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS added, count(n.apply_id) AS online,
          count(k.apply_id) + sum(CASE WHEN k.apply_id IS NULL THEN 1 ELSE 0 END) >= count(n.apply_id) AS ok
        FROM k FULL JOIN n ON k.app_id = n.app_id AND k.apply_id = n.apply_id GROUP BY 1""",
)
def sync_count_guard(spark, sf):
    return sync.count_guard(*kept_and_online(spark, sf), "app_id", "apply_id")


@query(
    "sync_tombstones",
    f"""WITH {KEPT} SELECT app_id, apply_id, 2147483647 AS log_id, '删除' AS audit_name, -1 AS audit_result,
          '2000-01-01 00:00:00' AS audit_time, CAST(NULL AS VARCHAR) AS after
        FROM (SELECT app_id, apply_id FROM kept EXCEPT SELECT app_id, apply_id FROM online)""",
)
def sync_tombstones(spark, sf):
    return sync.tombstones(*kept_and_online(spark, sf), "app_id", "apply_id", F.lit("2000-01-01 00:00:00"))


@query(
    "sync_high_water_bounds",
    f"""WITH {KEPT}, low AS (SELECT app_id, max(update_time) AS low FROM kept GROUP BY 1),
          high AS (SELECT app_id, max(update_time) - INTERVAL 30 DAY AS newest FROM online GROUP BY 1)
        SELECT f.app_id, f.apply_id, f.log_id FROM online f LEFT JOIN low ON low.app_id = f.app_id LEFT JOIN high ON high.app_id = f.app_id
        WHERE (low IS NULL OR f.update_time >= low) AND (newest IS NULL OR f.update_time <= newest)""",
)
def sync_high_water_bounds(spark, sf):
    kept, online = kept_and_online(spark, sf)
    first_seen = online.groupBy("app_id").agg((F.max("update_time") - F.expr("interval 30 days")).alias("newest"))
    out = sync.high_water_bounds(online, kept, "app_id", "update_time", "update_time", first_seen)
    return out.drop("update_time")
