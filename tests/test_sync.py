"""Key sync, snapshot diff and reconciliation on small tables."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import reconcile as rc
from ledgerspark.operators import sync
from ledgerspark.plans import catalog
from ledgerspark.session import parts_of
from tests.oracle import compare, connect

WIDE = "field string, no string, name string, number long"
THREE = [(f"f{i}", f"n{i}", f"name{i}", i) for i in (1, 2, 3)]


def changes(source, target, key):
    return {r.change: r.n for r in sync.change_counts(sync.sync_by_key(source, target, key)).collect()}


def test_sync_counts(spark):
    empty = spark.createDataFrame([], WIDE)
    rows = spark.createDataFrame(THREE, WIDE)
    assert changes(rows, empty, "no") == {"insert": 3}
    assert changes(rows, rows, "no") == {}
    assert changes(rows, rows, "number") == {}
    narrow = rows.select("field", "no")
    assert changes(narrow, rows, "no") == {}
    moved = spark.createDataFrame([("f2", "n2"), ("f3", "n3"), ("f1", "n4")], "field string, no string")
    assert changes(moved, rows, "no") == {"insert": 1, "delete": 1}


def test_sync_twice_changes_nothing(spark):
    rows = spark.createDataFrame(THREE, WIDE)
    source = spark.createDataFrame([("x", "n2"), ("f3", "n3"), ("f1", "n4")], "field string, no string")
    after = sync.apply_changes(rows, sync.sync_by_key(source, rows, "no"), "no")
    assert changes(source, after, "no") == {}
    assert {r.no: r.name for r in after.collect()} == {"n2": "name2", "n3": "name3", "n4": None}


def test_null_keys_match_each_other(spark):
    schema = "k long, v string"
    both = spark.createDataFrame([(None, "a"), (1, "b")], schema)
    assert changes(both, both, "k") == {}
    moved = spark.createDataFrame([(None, "z"), (2, "c")], schema)
    assert changes(moved, both, "k") == {"insert": 1, "delete": 1, "update": 1}
    after = sync.apply_changes(both, sync.sync_by_key(moved, both, "k"), "k")
    assert sorted(map(tuple, after.collect()), key=str) == [(2, "c"), (None, "z")]
    gone = sync.snapshot_diff(both, moved.filter("k = 2"), "k")
    assert [tuple(r) for r in gone.filter("flag = 0").collect()] == [(2, "c", 0, None)]
    assert sorted((r.k, r.change_type) for r in gone.filter("flag = 1 AND k IS NOT NULL").collect()) == [(1, "delete"), (2, "insert")]
    assert gone.filter("k IS NULL").collect()[0].change_type == "delete"


def test_repeated_key_is_an_error(spark):
    rows = spark.createDataFrame(THREE + THREE[:1], WIDE)
    with pytest.raises(Exception, match="key is not unique"):
        changes(rows, spark.createDataFrame([], WIDE), "no")


def test_snapshot_diff_rebuilds_new(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", True), (3, "c", False)], "k int, v string, w boolean")
    new = spark.createDataFrame([(1, "a", None), (2, "b", False), (4, "d", True)], "k int, v string, w boolean")
    out = sync.snapshot_diff(old, new, "k")
    assert sorted(r.k for r in out.filter("flag = 0").collect()) == [1, 2, 4]
    assert {r.k: r.change_type for r in out.filter("flag = 1").collect()} == {2: "update", 3: "delete", 4: "insert"}


def test_reconcile(spark):
    ledger = spark.sql(
        """SELECT 1 AS hash, timestamp(t) AS ts,
             array(named_struct('time', t, 'txn_no', no, 'amount', amt, 'account', acc)) AS payment,
             named_struct('order_no', 'O' || no) AS `order`
           FROM VALUES ('2020-01-01 10:00:00', 'p1', 500L, 'A'), ('2020-01-01 11:00:00', 'p2', 300L, 'A'),
                       ('2020-01-02 10:00:00', 'p3', 700L, 'A'), ('2020-01-02 10:00:00', null, 11L, 'A'), ('2020-01-02 10:00:00', 'p4', 100L, 'B') AS v(t, no, amt, acc)"""
    )
    bills = spark.sql(
        """SELECT timestamp(t) AS pay_time, no AS pay_order, amt AS pay_amount
           FROM VALUES ('2020-01-01 10:05:00', 'p1', -500L), ('2020-01-01 11:05:00', 'p2', -250L),
                       ('2020-01-02 12:00:00', 'x9', -40L) AS v(t, no, amt)"""
    )
    out = rc.reconcile_bills(ledger, bills, "2020-01-01", "2020-01-03")
    # account B has no matched bill and is not reconciled; p1 adds up to 0
    assert {r.order_no: r.amount for r in out.collect()} == {"p2": 50, "p3": 700, "x9": -40, None: 11}
    settled = spark.createDataFrame([("p3", "Op3", -700, "A"), ("p0", "Op0", 5, "A")], "order_no string, order_no2 string, amount long, account string")
    carried = rc.carry_forward(out, settled.withColumn("time", F.to_timestamp(F.lit("2019-12-31"))), "2020-01-01")
    assert {r.order_no: r.amount for r in carried.collect()} == {"p2": 50, "x9": -40, "p0": 5, None: 11}


def test_bill_files(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("trade_time,order_no,amount,refund,fee\n`2020-01-01 10:00:00,`p1,`12.34,`2.00,`0.07\n`bad,`,`x,,\n")
    rows = {r.pay_order: (str(r.pay_time), r.pay_amount) for r in rc.load_bill_a(spark, str(a)).collect()}
    assert rows == {"p1": ("2020-01-01 10:00:00", -1027), "": ("None", 0)}
    b = tmp_path / "b.csv"
    b.write_text(
        "book_time,flow_no,business_type,amount\n`2020-01-01 10:00:00,`f1,`交易,`5.00\n`2020-01-01 10:00:00,`f2,`退款,`5.00\n"
        "`2020-01-01 10:00:00,`f3,`扣除交易手续费,`0.03\n`2020-01-01 10:00:00,`f4,`其他,`9.00\n"
    )
    assert {r.pay_order: r.pay_amount for r in rc.load_bill_b(spark, str(b)).collect()} == {"f1": -500, "f2": 500, "f3": 3, "f4": 0}
    c = tmp_path / "c.csv"
    c.write_bytes(
        "#账单\ndone_time,trade_no,business_type,amount,service_fee\n2020-01-01 10:00:00\t,t1\t,交易付款,5.00,-0.03\n"
        ",t2,退款（部分）,-1.50,0.00\n2020-01-01 10:00:00,t3,提现,9.00,0\n#end\n".encode("gb2312")
    )
    rows = {r.pay_order: (str(r.pay_time), r.pay_amount) for r in rc.load_bill_c(spark, str(c)).collect()}
    assert rows == {
        "t1": ("2020-01-01 10:00:00", -497), "t2": ("2000-01-01 00:00:00", 150), "t3": ("2020-01-01 10:00:00", 0),
    }


def test_money_text_is_rounded_once(spark):
    df = spark.createDataFrame([("1.004999",), ("1.005",), ("-1.005",), ("12",), ("x",), (None,)], "t string")
    assert [r.c for r in df.select(rc.text_cents(F.col("t")).alias("c")).collect()] == [100, 101, -101, 1200, None, None]


def test_enrich_missing_takes_as_many_parts_as_its_rows_need(spark, monkeypatch):
    """A task sorts its part, so parts follow the rows, whatever number a shuffle has."""
    from ledgerspark.plans import sync as plans

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(plans, "parts_of", lambda df: parts_of(df, 200))
    few = spark.read.parquet(f"{sf}/lineitem.parquet").count() // 200
    out = plans.snapshot_enrich_missing(spark, sf)
    assert out.rdd.getNumPartitions() >= few > 8
    assert compare(out, connect(sf), dict(catalog.ORACLE)["snapshot_enrich_missing"]) is None
