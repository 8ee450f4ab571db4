"""Streams over the event table, landed as files and read as they come."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.plans.registry import query
from ledgerspark.session import cents, new_path, table
from ledgerspark.sources.latest import LatestTable
from ledgerspark.sources.versions import VersionedTable
from ledgerspark.streaming import jobs


def in_batches(spark, sf, run):
    """Land the events in two parts and run a job after each, two files to a batch: the second run
    goes on from the checkpoint of the first."""
    path, checkpoint = new_path(spark, "landing"), new_path(spark, "checkpoint")
    events = table(spark, sf, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.filter(early), events.filter(~early)):
        part.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.mode("append").parquet(path)
        run(jobs.file_stream(spark, path, events.schema, files_per_batch=2), checkpoint)


@query("stream_append_to_table", "SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS amount FROM events")
def stream_append_to_table(spark, sf):
    path = new_path(spark, "appended")
    in_batches(spark, sf, lambda stream, checkpoint: jobs.append_to_table(stream, path, checkpoint))
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", cents(F.col("value")).alias("amount"))


@query(
    "stream_daily_rollup",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount,
         count(*) AS payments FROM events GROUP BY 1, 2""",
)
def stream_daily_rollup(spark, sf):
    path, keys = new_path(spark, "windows"), ["event_type"]
    in_batches(spark, sf, lambda stream, at: jobs.daily_rollup(stream, "ts", keys, cents(F.col("value")), path, at))
    return VersionedTable(spark, path, "date").read().select(F.col("date").cast("string").alias("date"), *keys, "amount", "payments")


@query("stream_audit_on_insert", "SELECT event_id AS emp_no, event_type AS name FROM events")
def stream_audit_on_insert(spark, sf):
    path, audit = new_path(spark, "inserted"), new_path(spark, "audit")
    in_batches(spark, sf, lambda stream, at: jobs.audit_on_insert(stream, path, audit, at, "event_id", "event_type"))
    return spark.read.parquet(audit).select("emp_no", "name")


@query(
    "stream_changelog_latest",
    """SELECT user_id, event_type, max(event_id) AS event_id, arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS amount
       FROM events GROUP BY 1, 2""",
)
def stream_changelog_latest(spark, sf):
    path, keys = new_path(spark, "changes"), ["user_id", "event_type"]
    in_batches(spark, sf, lambda stream, at: jobs.changelog_latest(stream, keys, "event_id", path, at, buckets=8, fold_after=3))
    return LatestTable(spark, path, keys, "event_id").read().select(*keys, "event_id", cents(F.col("value")).alias("amount"))


@query(
    "stream_changelog_tombstones",
    """SELECT user_id, event_id, event_type FROM (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
         FROM events GROUP BY 1) WHERE event_type <> 'error'""",
)
def stream_changelog_tombstones(spark, sf):
    """Users by their last event; an error removes the user until the next one."""
    path, keys = new_path(spark, "changes"), ["user_id"]
    gone = F.col("event_type") == "error"
    in_batches(spark, sf, lambda stream, at: jobs.changelog_latest(stream, keys, "event_id", path, at, buckets=8, gone=gone, fold_after=2))
    return LatestTable(spark, path, keys, "event_id").read().select("user_id", "event_id", "event_type")
