"""Streams of several batches, restarted from their checkpoint, with late and repeated rows."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.sources.latest import LatestTable
from ledgerspark.sources.versions import VersionedTable
from ledgerspark.streaming import jobs

SCHEMA = "ts timestamp, kind string, id long, v long"


@pytest.fixture
def landing(spark, tmp_path):
    """Lands rows as one file each time and gives a stream with one file to a batch."""
    path = str(tmp_path / "landing")
    schema = spark.createDataFrame([], SCHEMA).schema

    def land(*rows):
        df = spark.createDataFrame([(f"2024-01-{r[0]}", *r[1:]) for r in rows], "t string, kind string, id long, v long")
        df.select(F.to_timestamp("t").alias("ts"), "kind", "id", "v").coalesce(1).write.mode("append").parquet(path)

    return land, lambda: jobs.file_stream(spark, path, schema, files_per_batch=1)


def rows_of(spark, path, *columns):
    return sorted(tuple(map(str, r)) for r in spark.read.parquet(path).select(*columns).collect())


def test_append_over_restarts(spark, tmp_path, landing):
    land, stream = landing
    path, audit, at = (str(tmp_path / n) for n in ("t", "audit", "checkpoint"))
    land(("01 10:00:00", "a", 1, 5))
    land(("02 10:00:00", "b", 2, 5))
    jobs.audit_on_insert(stream(), path, audit, at, "id", "kind")
    land(("03 10:00:00", "c", 3, 5))
    jobs.audit_on_insert(stream(), path, audit, at, "id", "kind")
    jobs.audit_on_insert(stream(), path, audit, at, "id", "kind")
    assert jobs.batches(spark, at) == 3
    assert rows_of(spark, path, "id") == [("1",), ("2",), ("3",)]
    assert rows_of(spark, audit, "emp_no", "name") == [("1", "a"), ("2", "b"), ("3", "c")]


def test_rollup_counts_late_rows_once(spark, tmp_path, landing):
    """Rows that are days, or months, behind are in their days after the run; other days are not written again."""
    land, stream = landing
    path, at = str(tmp_path / "totals"), str(tmp_path / "checkpoint")
    totals = VersionedTable(spark, path, "date")

    def run():
        jobs.daily_rollup(stream(), "ts", ["kind"], F.col("v"), path, at)
        return sorted(((str(r.date)[5:], r.kind, r.amount, r.payments) for r in totals.read().collect()), key=str)

    def directories():
        return {r.directory.split("/")[1]: r.directory for r in totals._manifest(totals.versions()[-1])}

    land(("01 10:00:00", "a", 1, 5), ("01 11:00:00", "b", 2, 7), ("05 11:00:00", None, 2, 3))
    land(("01 12:00:00", "a", 3, 10))
    assert run() == [("01-01", "a", 15, 2), ("01-01", "b", 7, 1), ("01-05", None, 3, 1)]
    land(("30 10:00:00", "a", 4, 1))
    run()
    before = directories()
    land(("02 10:00:00", "a", 5, 100), ("01 13:00:00", "a", 7, 100))
    assert run() == [("01-01", "a", 115, 3), ("01-01", "b", 7, 1), ("01-02", "a", 100, 1), ("01-05", None, 3, 1), ("01-30", "a", 1, 1)]
    after = directories()
    assert [d for d in before if before[d] != after[d]] == ["date=2024-01-01"]


def test_a_repeated_batch_adds_nothing(spark, tmp_path, landing, monkeypatch):
    """A run fails after its batch is in the table and before the batch is committed; the next run repeats the batch."""
    land, stream = landing
    path, at = str(tmp_path / "totals"), str(tmp_path / "checkpoint")
    run = lambda: jobs.daily_rollup(stream(), "ts", ["kind"], F.col("v"), path, at)
    land(("01 10:00:00", "a", 1, 5))
    run()
    land(("01 11:00:00", "a", 2, 7))
    replace = VersionedTable.replace_partitions

    def fail_after(*args):
        replace(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "replace_partitions", fail_after)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert [(r.amount, r.payments) for r in VersionedTable(spark, path, "date").read().collect()] == [(12, 2)]


def latest(spark, path, keys=("kind",), columns=("kind", "id", "v")):
    return sorted(tuple(map(str, r)) for r in LatestTable(spark, path, keys, "id").read().select(*columns).collect())


def test_latest_entry_by_key(spark, tmp_path, landing):
    land, stream = landing
    path, at = str(tmp_path / "latest"), str(tmp_path / "checkpoint")

    def run():
        jobs.changelog_latest(stream(), ["kind"], "id", path, at, buckets=3, fold_after=2)

    land(("01 10:00:00", "a", 1, 5), ("01 10:00:00", "a", 3, 6), ("01 10:00:00", "b", 2, 7))
    land(("02 10:00:00", "c", 4, 8), ("02 10:00:00", None, 5, 9))
    run()
    # an older entry of a, a newer one of b, a null key again, an entry without a number, and a repeated one
    land(("03 10:00:00", "a", 2, 0), ("03 10:00:00", "b", 9, 1), ("03 10:00:00", None, 6, 2), ("03 10:00:00", "d", None, 2), ("03 10:00:00", "c", 4, 8))
    run()
    assert jobs.batches(spark, at) == 3
    assert latest(spark, path) == [("None", "6", "2"), ("a", "3", "6"), ("b", "9", "1"), ("c", "4", "8")]
    changed = spark.read.parquet(f"{path}/changes").filter("batch = 2")
    assert sorted((str(r.kind), r.id) for r in changed.collect()) == [("None", 6), ("a", 3), ("b", 9), ("c", 4)]


def test_removed_keys_and_late_entries(spark, tmp_path, landing):
    land, stream = landing
    path, at = str(tmp_path / "latest"), str(tmp_path / "checkpoint")

    def run(*rows):
        land(*[("01 10:00:00", *r) for r in rows])
        jobs.changelog_latest(stream(), ["kind"], "id", path, at, buckets=3, gone=F.col("v") < 0, fold_after=2)
        return latest(spark, path)

    assert run(("a", 1, 5), ("b", 2, 5)) == [("a", "1", "5"), ("b", "2", "5")]
    assert run(("a", 4, -1)) == [("b", "2", "5")]
    assert run(("a", 3, 7)) == [("b", "2", "5")]  # older than the removal
    assert run(("c", 6, -1), ("b", 5, 1)) == [("b", "5", "1")]
    assert run(("a", 7, 9), ("c", 8, -1)) == [("a", "7", "9"), ("b", "5", "1")]


def test_a_changed_key_rewrites_no_other_bucket(spark, tmp_path):
    """One of 100,000 keys changes: the batch writes one row, the fold one of 64 buckets."""
    landing, path, at = (str(tmp_path / n) for n in ("landing", "latest", "checkpoint"))
    schema = spark.createDataFrame([], "id long, kind long, v long").schema

    def run(rows):
        rows.coalesce(1).write.mode("append").parquet(landing)
        jobs.changelog_latest(jobs.file_stream(spark, landing, schema, 1), ["kind"], "id", path, at, buckets=64, fold_after=1)
        base = LatestTable(spark, path, ["kind"], "id").base
        return {r.directory.split("/")[1]: r.directory for r in base._manifest(base.versions()[-1])}

    first = run(spark.range(100000).selectExpr("id", "id AS kind", "1L AS v"))
    then = run(spark.createDataFrame([(10**9, 777, 2)], schema))
    assert len(first) == 64 and sum(first[b] != then[b] for b in first) == 1
    assert spark.read.parquet(f"{path}/changes").filter("batch = 1").count() == 1
    table = LatestTable(spark, path, ["kind"], "id").read()
    assert table.count() == 100000 and [r.kind for r in table.filter("v = 2").collect()] == [777]
