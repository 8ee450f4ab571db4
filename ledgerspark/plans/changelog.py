"""Change logs: of account snapshots, of the event stream and of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions.scalars import lookup
from ledgerspark.operators import changelog as cl
from ledgerspark.operators.ordered import Previous, with_running
from ledgerspark.plans.registry import query
from ledgerspark.operators.replay import CheckedLog, ReplayedState
from ledgerspark.plans.snapshots import NEW, OLD
from ledgerspark.session import cents, new_path, stored, table


def account_cells(spark, sf, start, end):
    """Per customer: its order total (plain field 1) and a table (field 5) of order counts, one row
    per priority and one sub-field per status; a count of 1 is left empty."""
    orders = table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end))
    )
    key = F.col("o_custkey").alias("entity")
    total = orders.groupBy(key).agg(F.array(F.sum(cents(F.col("o_totalprice"))).cast("string")).alias("values"))
    sub = F.when(F.col("o_orderstatus") == "F", 51).when(F.col("o_orderstatus") == "O", 52).otherwise(53)
    ordinal = F.left("o_orderpriority", F.lit(1)).cast("int")
    n = F.count(F.lit(1))
    empty = F.array().cast("array<string>")
    counts = orders.groupBy(key, ordinal.alias("ordinal"), sub.alias("sub")).agg(
        F.when(n > 1, F.array(n.cast("string"))).otherwise(empty).alias("values")
    )
    plain = total.select("entity", F.lit(1).alias("field"), F.lit(-1).alias("ordinal"), F.lit(-1).alias("sub"), "values")
    return plain.unionByName(counts.select("entity", F.lit(5).alias("field"), "ordinal", "sub", "values"))


def cells_sql(start: str, end: str) -> str:
    where = f"o_orderdate >= TIMESTAMP '{start}' AND o_orderdate < TIMESTAMP '{end}'"
    return f"""SELECT o_custkey AS entity, 1 AS field, -1 AS ordinal, -1 AS sub,
        CAST(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS VARCHAR) AS v FROM orders WHERE {where} GROUP BY 1
      UNION ALL SELECT o_custkey, 5, CAST(left(o_orderpriority, 1) AS INTEGER),
        CASE o_orderstatus WHEN 'F' THEN 51 WHEN 'O' THEN 52 ELSE 53 END,
        CASE WHEN count(*) > 1 THEN CAST(count(*) AS VARCHAR) ELSE '' END FROM orders WHERE {where} GROUP BY 1, 3, 4"""


@query(
    "changelog_patch",
    f"""WITH b AS ({cells_sql(*OLD)}), a AS ({cells_sql(*NEW)}),
          c AS (SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.field, b.field) AS field,
                  coalesce(a.ordinal, b.ordinal) AS ordinal, coalesce(a.sub, b.sub) AS sub, a.v AS av, b.v AS bv
                FROM a FULL JOIN b ON a.entity = b.entity AND a.field = b.field AND a.ordinal = b.ordinal AND a.sub = b.sub),
          f AS (SELECT *, bool_or(av IS NOT NULL) OVER (PARTITION BY entity, field) AS field_stays,
                  bool_or(av IS NOT NULL) OVER (PARTITION BY entity, field, ordinal) AS row_stays FROM c),
          p AS (SELECT entity, field, ordinal, sub, av,
                  CASE WHEN av <> '' AND ordinal < 0 AND bv IS NULL THEN 'add'
                       WHEN av <> '' THEN 'replace'
                       WHEN ordinal < 0 AND av IS NULL AND bv <> '' THEN 'remove'
                       WHEN ordinal >= 0 AND av = '' AND bv <> '' THEN 'remove'
                       WHEN ordinal >= 0 AND av IS NULL AND field_stays AND NOT row_stays THEN 'remove' END AS op FROM f)
        SELECT entity, field, ordinal, sub, op, CASE WHEN op <> 'remove' THEN av END AS value FROM p WHERE op IS NOT NULL""",
)
def changelog_patch(spark, sf):
    patch = cl.changelog_patch(account_cells(spark, sf, *OLD), account_cells(spark, sf, *NEW), ["entity"])
    return patch.withColumn("value", F.array_join("values", "|")).drop("values")


def event_log(spark, sf):
    """Events as a log per (user, field): clicks are added to, small values remove, others replace."""
    kind = F.col("event_type")
    op = F.when(F.col("value") < 2, "remove").when(kind == "click", "add").otherwise("replace")
    values = F.when(op != "remove", F.array(cents(F.col("value")).cast("string")))
    return table(spark, sf, "events").select(
        "user_id", kind.alias("field"), F.col("event_id").alias("log_id"), op.alias("op"), values.alias("values")
    )


EVENT_LOG = """log AS (SELECT user_id, event_type AS field, event_id AS log_id, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v,
    CASE WHEN value < 2 THEN 'remove' WHEN event_type = 'click' THEN 'add' ELSE 'replace' END AS op FROM events)"""


REBUILT = f"""WITH {EVENT_LOG}, r AS (SELECT *, min(CASE WHEN op <> 'add' THEN log_id END) OVER (PARTITION BY user_id, field ORDER BY log_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS valid_to FROM log)
    SELECT user_id, field, log_id AS valid_from, valid_to, 0 AS nth, v AS value FROM r WHERE op <> 'remove'"""


@query("changelog_rebuild_state", REBUILT)
def changelog_rebuild_state(spark, sf):
    return cl.changelog_rebuild_state(event_log(spark, sf), ["user_id", "field"])


def replayed_events(spark, sf):
    """The event log, read up to the snapshot and then to its end: version 0 of the state, and version 1."""
    log = ReplayedState(spark, new_path(spark, "replayed"), ["user_id", "field"], buckets=16)
    seen = table(spark, sf, "events").filter(F.col("ts") < F.lit(SNAPSHOT_AT)).agg(F.max("event_id")).first()[0]
    log.read(event_log(spark, sf).filter(F.col("log_id") <= seen))
    log.read(event_log(spark, sf))
    return log


@query("changelog_rebuild_from_mark", REBUILT)
def changelog_rebuild_from_mark(spark, sf):
    """The same from a kept state: the second run reads the entries after the first one's last only."""
    return replayed_events(spark, sf).rebuilt()


def priority_log(spark, sf):
    """Orders as entries of a log per customer. Entries are numbered by order key while ``before``
    was recorded by order date, so many do not fit the entry before them."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", F.array("o_orderpriority").alias("after")
    )
    recorded = with_running(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], before=Previous("after"))
    return recorded.select("o_custkey", F.col("o_orderkey").alias("log_id"), "before", "after")


BEFORE = """WITH r AS (SELECT o_custkey, o_orderkey AS log_id, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS recorded,
          lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS state FROM orders)
    SELECT o_custkey, log_id, coalesce(recorded, '') AS recorded, coalesce(state, '') AS state FROM r WHERE recorded IS DISTINCT FROM state"""


def as_text(found):
    return found.withColumns({c: F.coalesce(F.array_join(c, "|"), F.lit("")) for c in ("recorded", "state")})


@query("changelog_check_before", BEFORE)
def changelog_check_before(spark, sf):
    return as_text(cl.changelog_check_before(priority_log(spark, sf), ["o_custkey"]))


@query("changelog_check_before_from_mark", BEFORE)
def changelog_check_before_from_mark(spark, sf):
    """The same in three runs, each from the last entries that the one before it kept."""
    log = stored(priority_log(spark, sf), "log")
    checked = CheckedLog(spark, new_path(spark, "checked"), ["o_custkey"], buckets=16)
    last = log.agg(F.max("log_id")).first()[0] or 0
    for upto in (last // 2, last // 2 + last // 4, last):
        checked.read(log.filter(F.col("log_id") <= upto))
    return as_text(checked.results())


SNAPSHOT_AT = "2024-01-25"
# field 2 is one that the form system fills itself, so errors take no part in the check
FIELD_CODES = {"error": 2, "signup": 11, "purchase": 12, "view": 13, "click": 14}
FIELD_SQL = "CASE field " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in FIELD_CODES.items()) + " END"


def final_sql(name: str, where: str) -> str:
    """State after the entries that meet ``where``: what was set or added since the last other entry."""
    return f"""{name}_r AS (SELECT user_id, field, max(log_id) FILTER (op <> 'add') AS since FROM timed WHERE {where} GROUP BY 1, 2),
      {name} AS (SELECT user_id, field, string_agg(v, '|' ORDER BY log_id) AS v FROM timed JOIN {name}_r USING (user_id, field)
        WHERE {where} AND op <> 'remove' AND log_id >= coalesce(since, 0) GROUP BY 1, 2)"""


@query(
    "changelog_check_final",
    f"""WITH {EVENT_LOG}, timed AS (SELECT log.*, events.ts FROM log JOIN events ON event_id = log_id WHERE field <> 'error'),
          {final_sql('l', 'true')}, {final_sql('r', f"ts < TIMESTAMP '{SNAPSHOT_AT}'")}
        SELECT user_id, {FIELD_SQL} AS field,
          CASE WHEN r.v IS NULL THEN 'only left' WHEN l.v IS NULL THEN 'only right' ELSE 'values' END AS problem
        FROM l FULL JOIN r USING (user_id, field) WHERE l.v IS DISTINCT FROM r.v""",
)
def changelog_check_final(spark, sf):
    # the online state was taken some days before the end of the log: it is the state that the second run went on from
    log, keys = replayed_events(spark, sf), ["user_id", "field"]

    def state(version):
        values = cl.final_state(log.values(version), keys).withColumnRenamed("field", "title")
        return values.withColumn("field", lookup(FIELD_CODES, F.col("title")))

    return cl.changelog_check_final(state(1), state(0), keys)
