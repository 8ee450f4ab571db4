"""Tables that are replaced in parts, versions, buckets, JDBC and file listings."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerspark.sources import files as fl
from ledgerspark.sources import partitions as pt
from ledgerspark.sources.jdbc import even_predicates, scan_jdbc, scan_jdbc_evenly, write_jdbc
from ledgerspark.operators.bitmaps import DistinctByDay
from ledgerspark.plans.files import jdbc_url, scan_jdbc_query
from ledgerspark.sources.versions import VersionedTable, merge_upsert


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_where_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, "007", "a:b"), (2, "007", "c+d"), (3, "08", "a:b"), (4, None, "a:b")]
    df = spark.createDataFrame(first, "id int, m string, x string")
    fl.write_partitioned(df, path, "m", "x")
    new = spark.createDataFrame([(9, "007", "a:b")], df.schema)
    pt.replace_where(new, path, ["m", "x"], F.col("m") == "007")
    read = spark.read.schema(df.schema).parquet(path)
    # the matching partition without new rows is gone, the others stay
    assert rows_of(read.select("id", "m", "x")) == sorted([(9, "007", "a:b"), (3, "08", "a:b"), (4, None, "a:b")], key=str)
    with pytest.raises(ValueError):
        pt.replace_where(new, path, ["m", "x"], F.col("m") == "08")
    pt.replace_where(new.limit(0), path, ["m", "x"], F.col("m") == "007")
    assert {r.id for r in spark.read.schema(df.schema).parquet(path).collect()} == {3, 4}


def test_replace_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, v string, app string"
    pt.replace_by_key(spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (1, "c", "y")], schema), path, ["id"], "app")
    pt.replace_by_key(spark.createDataFrame([(2, "B", "x"), (3, "n", "x")], schema), path, ["id"], "app")
    assert rows_of(spark.read.parquet(path).select("id", "v", "app")) == [
        (1, "a", "x"), (1, "c", "y"), (2, "B", "x"), (3, "n", "x"),
    ]


def test_replace_by_key_nulls_and_extra_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, v string, app int, extra string"
    first = [(1, "a", None, "e1"), (2, "b", None, "e2"), (None, "n", None, "e3"), (1, "x", 7, "e4"), (1, "y", 8, "e5")]
    pt.replace_by_key(spark.createDataFrame(first, schema), path, ["id"], "app")
    new = spark.createDataFrame([(2, "B", None), (None, "N", None), (5, "z", 7)], "id int, v string, app int")
    pt.replace_by_key(new, path, ["id"], "app")
    assert rows_of(spark.read.parquet(path).select("id", "v", "app", "extra")) == sorted(
        [(1, "a", None, "e1"), (2, "B", None, None), (None, "N", None, None), (1, "x", 7, "e4"), (5, "z", 7, None), (1, "y", 8, "e5")],
        key=str,
    )
    with pytest.raises(ValueError, match="repeated"):
        pt.replace_by_key(new.union(new), path, ["id"], "app")


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "v"))
    assert not t.exists() and t.read(schema="id long").columns == ["id"]
    t.write(spark.range(5))
    t.write(spark.range(5, 10))
    t.update(F.col("id") % 2 == 0, id=F.col("id") + 100)
    t.delete(F.col("id") % 2 == 0)
    t.merge(spark.range(5, 20), ["id"], [])
    assert t.versions() == [0, 1, 2, 3, 4]
    assert rows_of(t.read(0)) == [(i,) for i in range(5)]
    assert rows_of(t.read(2)) == sorted([(5,), (7,), (9,), (106,), (108,)], key=str)
    assert {r.id for r in t.read().collect()} == set(range(5, 20))
    with pytest.raises(ValueError):
        t.read(9)


def test_versions_by_partition(spark, tmp_path):
    import os

    path = str(tmp_path / "v")
    schema = "id int, v string, p string"
    t = VersionedTable(spark, path, part="p")
    assert not t.exists() and t.read(schema=schema).count() == 0
    t.write(spark.createDataFrame([(1, "a", "007"), (2, "b", "x y"), (3, "c", None), (4, "d", "z")], schema))
    partitions = lambda n: sorted(d for d in os.listdir(f"{path}/table_version={n}") if d.startswith("p="))
    assert t.update(F.col("id") == 2, v=F.lit("B")) == 1 and partitions(1) == ["p=x y"]
    assert t.delete(F.col("id").isin(3, 4)) == 2 and partitions(2) == []
    source = spark.createDataFrame([(1, "A", "z"), (9, "n", None), (8, "m", "w")], schema)
    assert t.merge(source, ["id"], ["v"]) == 3 and partitions(3) == ["p=007", "p=__HIVE_DEFAULT_PARTITION__", "p=w"]
    t.replace_where(spark.createDataFrame([(7, "r", "007")], schema), F.col("p").isin("007", "w"))
    assert t.versions() == [0, 1, 2, 3, 4]
    assert rows_of(t.read(0)) == sorted([(1, "a", "007"), (2, "b", "x y"), (3, "c", None), (4, "d", "z")], key=str)
    assert rows_of(t.read(2)) == sorted([(1, "a", "007"), (2, "B", "x y")], key=str)
    assert rows_of(t.read(3)) == sorted([(1, "A", "007"), (2, "B", "x y"), (8, "m", "w"), (9, "n", None)], key=str)
    assert rows_of(t.read()) == sorted([(7, "r", "007"), (2, "B", "x y"), (9, "n", None)], key=str)
    with pytest.raises(ValueError):
        t.replace_where(source, F.col("p") == "z")
    with pytest.raises(ValueError):
        t.update(F.col("id") == 2, p=F.lit("q"))
    t.delete(F.lit(True))
    assert t.read().count() == 0


def test_bucketed_within_partitions(spark):
    name = fl.write_bucketed(spark.range(100).withColumn("p", F.col("id") % 3), "id", 4, ["p"])
    assert spark.table(name).filter("p = 1").count() == 33
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Num Buckets"] == "4" and "`p`" in spark.sql(f"SHOW CREATE TABLE {name}").first()[0] or "p" in detail


def test_merge_rejects_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    source = spark.createDataFrame([(1, "n"), (3, "m")], "id int, v string")
    assert rows_of(merge_upsert(target, source, ["id"], ["v"])) == [(1, "n"), (1, "n"), (2, "c"), (3, "m")]
    with pytest.raises(Exception, match="not unique"):
        merge_upsert(target, source.union(source), ["id"], ["v"]).collect()


def test_update_and_delete_keep_null_conditions(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "id int, v int")
    assert rows_of(fl.condition_delete(df, F.col("v") > 2)) == [(1, 1), (2, None)]
    assert rows_of(fl.condition_update(df, F.col("v") > 2, v=F.lit(0))) == [(1, 1), (2, None), (3, 0)]


def test_bucketed_join_has_no_shuffle(spark):
    left = spark.table(fl.write_bucketed(spark.range(1000).withColumnRenamed("id", "a"), "a", 42))
    right = spark.table(fl.write_bucketed(spark.range(1000).withColumnRenamed("id", "b"), "b", 42))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, F.col("a") == F.col("b"))
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jdbc_round_trip(spark):
    """An in-process Derby database: no server and no port."""
    url = "jdbc:derby:memory:ledgertest;create=true"
    write_jdbc(spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name")), url, "people")
    back = scan_jdbc(spark, url, "people", split_on="id", lower=10, upper=50, splits=4)
    assert back.count() == 100 and back.rdd.getNumPartitions() == 4


def test_jdbc_needs_a_named_database_on_executors():
    """Executors do not see the database of the driver's process; those of ``local-cluster`` are processes too."""
    session = lambda **conf: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.split(".")[-1], d)))
    for master in ("local-cluster[3,4,10240]", "spark://a:1", "yarn"):
        with pytest.raises(RuntimeError, match="spark.ledgerspark.jdbc.url"):
            jdbc_url(session(master=master))
        assert jdbc_url(session(master=master, url="jdbc:x")) == "jdbc:x"
    for master in ("local", "local[8]", "local[*]", "local[2,3]"):
        assert jdbc_url(session(master=master)).startswith("jdbc:derby:memory:")


def test_jdbc_query_without_keys(spark, tmp_path):
    """No rows, null keys only, some null keys, keys below zero: every row comes back."""
    rows = [(None, "a", 1.25), (None, "b", None), (-7, "c", -3.5), (-900, None, 0.0), (4, "e", 2.0)]
    for label, kept in (("none", []), ("nulls", rows[:2]), ("below", rows[2:4]), ("all", rows)):
        spark.createDataFrame(kept, "c_custkey long, c_name string, c_acctbal double").write.parquet(str(tmp_path / label / "customer.parquet"))
        back = scan_jdbc_query(spark, str(tmp_path / label))
        want = [(k, n, None if b is None else round(b * 100)) for k, n, b in kept]
        assert rows_of(back) == sorted(want, key=str), label


def test_even_splits_of_a_skewed_column(spark):
    """Nearly all values in a small part of the range, nulls, dates and times; every row meets one condition."""
    skewed = F.when(F.col("id") % 50 > 0, F.pow(F.lit(1.004), F.col("id") % 4000).cast("long")).when(F.col("id") % 100 > 0, F.lit(10**12))
    df = spark.range(8000).select(skewed.alias("v"), F.col("id"))
    parts = [df.filter(p).count() for p in even_predicates(df, "v", 8)]
    assert len(parts) == 8 and sum(parts) == 8000 and max(parts) <= 2 * sorted(parts)[4]
    uniform = [df.filter(f"v >= {i} * 125000000000 AND v < ({i} + 1) * 125000000000").count() for i in range(8)]
    assert max(uniform) > 7000  # what equal ranges would give
    times = spark.range(900).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.sqrt("id") * 3).cast("int")).alias("d"), F.timestamp_seconds(F.col("id") * 997).cast("timestamp_ntz").alias("t"))
    for column in ("d", "t"):
        parts = [times.filter(p).count() for p in even_predicates(times, column, 4)]
        assert sum(parts) == 900 and max(parts) < 300
    one = spark.createDataFrame([(5,)] * 9 + [(None,)], "v int")
    assert [one.filter(p).count() for p in even_predicates(one, "v", 4)] == [1, 9]
    assert even_predicates(one.limit(0), "v", 4) == even_predicates(one, "v", 1) == ["1 = 1"]


def test_jdbc_in_even_parts(spark):
    url = "jdbc:derby:memory:ledgereven;create=true"
    write_jdbc(spark.range(300).select("id", (F.col("id") * F.col("id") * F.col("id")).alias("v")), url, "cubes")
    back = scan_jdbc_evenly(spark, url, "cubes", '"v"', splits=5, sampled='MOD("id", 3) = 0')
    sizes = [r.n for r in back.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 300 and len(sizes) == 5 and max(sizes) < 70


def test_distinct_counts_from_bitmaps_of_days(spark, tmp_path):
    """Any range of days, values below zero and far apart, nulls, repeated rows, and a day that is loaded again."""
    import random

    rng = random.Random(2)
    rows = [(f"2024-01-{rng.randrange(1, 10):02}", rng.choice(["a", "b", None]), rng.choice([None, -5, 0, 1, 32768, 32769, 10**12, rng.randrange(200)])) for _ in range(800)]
    frame = lambda r: spark.createDataFrame(r, "d string, k string, v long").select(F.to_date("d").alias("date"), "k", "v")
    kept = DistinctByDay(spark, str(tmp_path / "b"), ["k"], "v")
    kept.load(frame(rows))
    again = [("2024-01-03", "a", 77), ("2024-01-03", "a", 77), ("2024-01-03", "c", None)]
    kept.load(frame(again))
    rows = [r for r in rows if r[0] != "2024-01-03"] + again
    for first, last in (("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-03"), ("2024-01-02", "2024-01-05"), ("2025-01-01", "2025-01-02")):
        want = {}
        for d, k, v in rows:
            if first <= d <= last and v is not None:
                want.setdefault(k, set()).add(v)
        assert {r.k: r.n for r in kept.counts(first, last).collect()} == {k: len(v) for k, v in want.items()}


def test_merge_by_partition_in_one_join(spark, tmp_path):
    """Repeated target keys over several partitions, null keys on both sides, keys of several columns, new columns, and repeated source keys."""
    schema = "a int, b int, v string, p string"
    t = VersionedTable(spark, str(tmp_path / "v"), part="p")
    t.write(spark.createDataFrame([(1, 1, "x", "m"), (1, 1, "y", "n"), (1, 1, "z", "n"), (2, None, "q", "m"), (3, 3, "r", "o")], schema))
    source = spark.createDataFrame([(1, 1, "new", "k"), (2, None, "null", "m"), (4, 4, "four", None)], schema)
    t.merge(source, ["a", "b"], ["v"])
    assert rows_of(t.read()) == sorted(
        [(1, 1, "new", "m"), (1, 1, "new", "n"), (1, 1, "new", "n"), (2, None, "q", "m"), (2, None, "null", "m"), (3, 3, "r", "o"), (4, 4, "four", None)], key=str
    )
    untouched = {r.directory for r in t._manifest(1) if r.directory.endswith("p=o")}
    assert untouched == {"table_version=0/p=o"}
    with pytest.raises(Exception, match="not unique"):
        t.merge(source.union(source), ["a", "b"], ["v"])


def test_file_listings(spark, tmp_path):
    path = str(tmp_path / "t")
    fl.write_partitioned(spark.createDataFrame([(1, 9), (2, 10), (3, None)], "id int, hash int"), path, "hash")
    stats = pt.partition_file_stats(spark, path, "hash int")
    assert sorted(str(r.hash) for r in stats.collect()) == ["10", "9", "None"]
    assert pt.partition_file_stats(spark, path, "hash int", hi="2001-01-01").count() == 0
    pruned = pt.data_files(spark, path, "hash int").filter("hash >= 10")
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(hash" in pruned._jdf.queryExecution().executedPlan().toString()
    # text order, the null partition left out
    assert pt.lead_partition(spark, path, "hash", "2001-01-01").first().lead == "10"
    assert pt.lead_partition(spark, path, "hash", "2100-01-01").first().lead is None
    bills = tmp_path / "bills"
    bills.mkdir()
    for name in ("shopAll2020-03-05.csv", "shopAll2020-02-01.csv", "x_20200110_1.csv", "note.txt"):
        (bills / name).write_text("x")
    found = pt.earliest_changed_bill_date(
        spark,
        [(str(bills), r"All(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"), (str(bills), r"_(\d{8})_", "yyyyMMdd")],
        "2001-01-01", glob="*.csv",
    )
    assert str(found.first().day) == "2020-01-10"


def test_json_strings_infer_over_all_rows(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":2.5,"b":{"c":"x"}}',), (None,)], "j string")
    out = fl.json_strings_to_table(df, "j")
    assert out.columns == ["a", "b"] and out.filter("b.c = 'x'").count() == 1
    odd = spark.createDataFrame([('{"OBJECT<":1,"m":1,"n":null,"d":1.5}',), ('{"m":"x","d":2}',)], "j string")
    table = fl.json_strings_to_table(odd, "j")
    assert dict(table.dtypes) == {"OBJECT<": "bigint", "m": "string", "n": "string", "d": "double"}
    assert sorted(r.m for r in table.collect()) == ["1", "x"]
    assert fl.json_strings_to_table(odd.limit(0), "j").columns == []


def test_scan_text_split(spark, tmp_path):
    p = tmp_path / "people.txt"
    p.write_text("Justin, 19\nAnn,x\nBob\n")
    from pyspark.sql.types import StructType

    out = fl.scan_text_split(spark, str(p), StructType().add("name", "string").add("age", "integer"))
    assert rows_of(out) == sorted([("Justin", 19), ("Ann", None), ("Bob", None)], key=str)
