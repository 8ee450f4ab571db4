"""Logs replayed from their mark against full rebuilds, with what a run reads and a run that fails."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import changelog as cl
from ledgerspark.operators.replay import CheckedLog, ReplayedState
from ledgerspark.sources.versions import VersionedTable

KEYS = ["entity", "field"]


def entries(seed, n, first=1, entities=(*range(12), None)):
    rng = random.Random(seed)
    rows = []
    for i in range(first, first + n):
        op = rng.choice(["add", "add", "replace", "remove"])
        rows.append((rng.choice(entities), rng.choice(["a", "b", None]), i, op, None if op == "remove" else [str(rng.randrange(9)) for _ in range(rng.randrange(4))]))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "entity int, field string, log_id long, op string, values array<string>")


def values(df):
    return sorted((str(r.entity), str(r.field), r.valid_from, r.valid_to or 0, r.nth, r.value) for r in df.collect())


def test_runs_equal_a_full_rebuild(spark, tmp_path):
    log = entries(1, 400)
    kept = ReplayedState(spark, str(tmp_path / "s"), KEYS, buckets=5)
    assert kept.mark() is None
    for upto in (150, 151, 151, 400):
        kept.read(frame(spark, log[:upto]))
        assert kept.mark() == upto
        full = cl.changelog_rebuild_state(frame(spark, log[:upto]), KEYS)
        assert values(kept.rebuilt()) == values(full)
        final = lambda d: sorted(map(str, cl.final_state(d, KEYS).collect()))
        assert final(kept.values()) == final(full)
    assert kept.state.versions() == [0, 1, 2]  # a run without new entries leaves no version


def test_a_run_reads_only_new_entries_and_their_buckets(spark, tmp_path):
    log = entries(2, 300)
    kept = ReplayedState(spark, str(tmp_path / "s"), KEYS, buckets=16)
    kept.read(frame(spark, log))
    tail = entries(3, 5, first=301, entities=(3,))
    want = values(cl.changelog_rebuild_state(frame(spark, log + tail), KEYS))
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(16))
    touched = {r[0] for r in frame(spark, tail).select(bucket).distinct().collect()}
    # entries before the mark are others now, and the buckets of other entities cannot be read
    changed = [(*r[:3], "replace", ["nonsense"]) for r in log] + tail
    saved = {}
    for path in glob.glob(f"{tmp_path}/s/state/table_version=0/bucket=*/*.parquet"):
        if int(path.split("bucket=")[1].split("/")[0]) not in touched:
            saved[path] = open(path, "rb").read()
            open(path, "wb").write(b"no parquet file")
    assert saved
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    assert set(kept.read(frame(spark, changed))) == touched
    for path, content in saved.items():
        open(path, "wb").write(content)
    directories = {r.directory.split("/")[0] for r in kept.state._manifest(1) if int(r.directory.split("=")[-1]) not in touched}
    assert directories == {"table_version=0"}
    assert values(kept.rebuilt()) == want


def test_a_failed_run_leaves_no_trace(spark, tmp_path, monkeypatch):
    log = entries(4, 200)
    kept = ReplayedState(spark, str(tmp_path / "s"), KEYS, buckets=4)
    kept.read(frame(spark, log[:100]))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "replace_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.read(frame(spark, log[:150]))
    assert kept.mark() == 100
    assert values(kept.rebuilt()) == values(cl.changelog_rebuild_state(frame(spark, log[:100]), KEYS))
    kept.read(frame(spark, log))
    assert values(kept.rebuilt()) == values(cl.changelog_rebuild_state(frame(spark, log), KEYS))


def test_checked_runs_equal_a_full_check(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, None]), i, rng.choice([None, [], ["x"], ["y"]]), rng.choice([None, ["x"], ["y"]])) for i in range(1, 120)]
    df = lambda r: spark.createDataFrame(r, "entity int, log_id long, before array<string>, after array<string>")
    checked = CheckedLog(spark, str(tmp_path / "c"), ["entity"], buckets=3)
    for upto in (40, 41, 119):
        checked.read(df(rows[:upto]))
        want = cl.changelog_check_before(df(rows[:upto]), ["entity"])
        assert sorted(map(str, checked.results().collect())) == sorted(map(str, want.collect()))
