"""Run registered queries next to their SQL in DuckDB and compare names, types and values.

python -m tests.oracle [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def rows(table: pa.Table) -> list[str]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted(repr(r) for r in zip(*cols)) if cols else []


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got, want = df.toArrow(), con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    for n in sorted(got.column_names):
        a, b = kind(got.schema.field(n).type), kind(want.schema.field(n).type)
        if a != b:
            return f"type of {n}: {a} != {b}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} of {len(a)} rows differ, first: {bad[0][0][:300]} != {bad[0][1][:300]}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in oracle:
                diff = compare(df, con, oracle[name])
                note = f"{df.count() if diff is None else '-'} rows"
            else:
                n, diff = df.count(), None
                note = f"{n} rows, no SQL"
        except Exception as e:  # report and go on with the next query
            diff, note = f"{type(e).__name__}: {str(e)[:700]}", ""
            if args.names:
                traceback.print_exc(limit=4)
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t0:.1f}s {diff or note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
