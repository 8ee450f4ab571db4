"""Report queries read the tables as they are, also when those change within a session."""

import os
import shutil

import duckdb

import __spark_entry__ as entry
from tests.oracle import compare, connect


def test_report_follows_rewritten_tables(spark, tmp_path):
    path = tmp_path / "sf"
    path.mkdir()
    for name in os.listdir("/root/testdata/sf0.001"):  # contents only: the data may be read-only for this user
        shutil.copyfile(f"/root/testdata/sf0.001/{name}", path / name)
    name = "reconcile_report_days"
    entry.QUERIES[name](spark, str(path)).collect()
    duckdb.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.001/lineitem.parquet' WHERE l_orderkey % 2 = 0) TO '{path}/lineitem.parquet' (FORMAT parquet)")
    assert compare(entry.QUERIES[name](spark, str(path)), connect(str(path)), entry.ORACLE[name]) is None
