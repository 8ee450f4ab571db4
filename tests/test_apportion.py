"""Expected values of the daily apportionment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import apportion as ap

A, X = "主营业务收入.收入.加液", "主营业务收入.收入.X"


def events(spark, rows):
    df = spark.createDataFrame([("c", *r) for r in rows], "c string, t string, subject string, income long")
    return df.withColumn("ts", F.to_timestamp("t")).drop("t")


def terms(spark, rows, rates):
    names = {"ratio": "rate_first double, rate_second double", "tiers": "tiers array<struct<k:double,a:bigint>>, rate_second double"}
    df = spark.createDataFrame(
        [("c", i, *r) for i, r in enumerate(rows)], f"c string, span int, s string, e string, fixed long, {names[rates]}"
    )
    return df.withColumns({"start_ts": F.to_timestamp("s"), "end_ts": F.to_timestamp("e")}).drop("s", "e")


def by_date(df):
    return {str(r.date): r.amount for r in df.collect()}


SIX = [
    ("2020-04-01 08:00", A, 2), ("2020-04-02 08:00", A, 2), ("2020-04-03 08:00", X, 4),
    ("2020-04-05 16:00", X, 4), ("2020-04-06 08:00", A, 4), ("2020-04-07 08:00", A, 2),
]
SPAN = ("2020-04-01 07:00", "2020-04-09 07:00")


def test_fixed_and_ratio(spark):
    ev = events(spark, SIX)
    fixed = by_date(ap.fixed_and_ratio_share(ev, terms(spark, [(*SPAN, 10, None, None)], "ratio"), ["c"]))
    assert len(fixed) == 8 and sum(fixed.values()) == 10
    assert fixed["2020-04-02"] == 2 and fixed["2020-04-06"] == 2
    ratio = by_date(ap.fixed_and_ratio_share(ev, terms(spark, [(*SPAN, None, 0.4, 0.8)], "ratio"), ["c"]))
    assert len(ratio) == 8 and sum(ratio.values()) == 11
    assert [ratio[f"2020-04-0{d}"] for d in (1, 2, 4, 6, 7)] == [2, 1, 0, 4, 1]
    both = by_date(ap.fixed_and_ratio_share(ev, terms(spark, [(*SPAN, 4, 0.4, 0.8)], "ratio"), ["c"]))
    assert len(both) == 8 and sum(both.values()) == 11
    assert [both[f"2020-04-0{d}"] for d in (1, 3, 4, 6, 8)] == [1, 4, 0, 4, 0]
    two = ap.fixed_and_ratio_share(
        ev, terms(spark, [(*SPAN, 10, None, None), (*SPAN, None, 0.4, 0.8)], "ratio"), ["c"]
    )
    assert two.count() == 16


def test_fixed_and_ratio_long_span(spark):
    ev = events(spark, [("2019-12-30 08:00", A, 2), ("2020-01-01 08:00", A, 2)])
    span = ("2019-12-30 07:00", "2020-04-09 07:00", 4, 0.4, 0.8)
    assert ap.fixed_and_ratio_share(ev, terms(spark, [span], "ratio"), ["c"]).count() == 101
    assert ap.fixed_and_ratio_share(ev, terms(spark, [span, span], "ratio"), ["c"]).count() == 202


TIERS = [(0.5, 0), (0.6, 4), (0.7, 6)]


def test_tiered(spark):
    out = by_date(ap.tiered_share(events(spark, SIX), terms(spark, [(*SPAN, None, TIERS, 0.8)], "tiers").drop("span", "fixed"), ["c"]))
    assert len(out) == 8 and sum(out.values()) == 13
    assert [out[f"2020-04-0{d}"] for d in (1, 2, 4, 6, 7)] == [2, 1, 0, 3, 2]


def test_tiered_rates_replaced(spark):
    t = terms(spark, [(*SPAN, None, TIERS, 0.8), ("2020-04-06 00:00", SPAN[1], None, [(1.0, 0)], 0.0)], "tiers")
    out = by_date(ap.tiered_share(events(spark, SIX), t.drop("span", "fixed"), ["c"]))
    # until 04-05: 4 * .8 + (8 * .5 + 4 * .1 + 2 * .1) = 7.8; from 04-06 on 8 * 1.0 of all first-rate income
    assert sum(v for d, v in out.items() if d < "2020-04-06") == 8
    assert out["2020-04-06"] == 0 and out["2020-04-08"] == 0


MIN_EVENTS = [
    ("2020-04-02 07:00", A, 2), ("2020-04-02 08:00", A, 2), ("2020-04-03 08:00", X, 4),
    ("2020-04-05 16:00", X, 4), ("2020-04-06 08:00", A, 4), ("2020-04-06 09:00", A, 2),
]


@pytest.mark.parametrize(
    "term, count, total, days",
    [
        ((*SPAN, 10, None, None), 8, 10, {2: 2, 6: 2}),
        ((*SPAN, None, [(0.4, 0)], 0.8), 4, 11, {2: 3, 3: 2, 5: 1, 6: 5}),
        (("2020-04-02 07:00", SPAN[1], None, [(0.4, 0)], 0.8), 4, 11, {2: 3, 3: 2, 5: 1, 6: 5}),
        ((*SPAN, 4, [(0.4, 0)], 0.8), 4, 11, {1: 1, 3: 4, 5: 1, 6: 5}),
        ((*SPAN, None, TIERS, 0.8), 4, 13, {2: 3, 3: 2, 5: 3, 6: 5}),
    ],
)
def test_guaranteed_min(spark, term, count, total, days):
    out = by_date(ap.guaranteed_min_share(events(spark, MIN_EVENTS), terms(spark, [term], "tiers"), ["c"]))
    assert len(out) == count and sum(out.values()) == total
    assert {d: out[f"2020-04-0{d}"] for d in days} == days


@pytest.mark.parametrize(
    "method, rates, expected",
    [
        ("days", [(0.0, 11)], [None] * 7 + [11]),
        ("amount", [(0.0, 11)], [0, 1, 4, 4, 8, 11, 11, 11]),
        ("amount", [(0.0, -11)], [0, -1, -4, -4, -8, -11, -11, -11]),
        ("amount", [(-0.4, 0)], [0, -2, -9, -9, -18, -26, -26, -26]),
        ("amount", [(-0.4, 0), (-0.5, 20), (-0.6, 45)], [0, -2, -9, -9, -21, -33, -33, -33]),
    ],
)
def test_share_by_strategy(spark, method, rates, expected):
    rows = [("c", n, v, 8, 65, method, rates) for n, v in [(1, 2), (1, 3), (2, 17), (4, 23), (5, 7), (5, 13), (8, None)]]
    df = spark.createDataFrame(
        rows, "c string, n int, v long, days int, total long, m string, r array<struct<k:double,a:bigint>>"
    )
    out = {r.n: r.amount for r in ap.share_by_strategy(df, ["c"], "n", "v", "days", "total", "m", "r").collect()}
    assert sorted(out) == list(range(8))
    assert all(e is None or out[i] == e for i, e in enumerate(expected))


def test_unknown_share_method_is_an_error(spark):
    df = spark.sql("select 'c' c, 1 n, 1L v, 1 days, 1L total, 'x' m, array(struct(0.0D as k, 1L as a)) r")
    with pytest.raises(Exception, match="unknown share method"):
        ap.share_by_strategy(df, ["c"], "n", "v", "days", "total", "m", "r").collect()


def test_min_of_two_running(spark):
    rows = [(1, 5, 1), (2, 3, 2), (3, 4, 2), (4, -2, 1), (5, 9, 1)]
    df = spark.createDataFrame(rows, "o int, amount long, item int").withColumn("k", F.lit("c"))
    out = [r.increase for r in ap.min_of_two_running(df, "amount", "item", ["k"], ["o"]).orderBy("o").collect()]
    c1 = c2 = 0
    want = []
    for _, a, i in rows:
        before = min(c1, c2)
        c1, c2 = (c1 + a, c2) if i == 1 else (c1, c2 + a)
        want.append(min(c1, c2) - before)
    assert out == want
    split = ap.min_of_two_running(df, "amount", "item", ["k"], ["o"], chunks=4).orderBy("o").collect()
    assert [r.increase for r in split] == want


def test_strategy_expand_months(spark):
    d = dt.date
    rows = [
        ("1", "主营业务成本.装修费", d(2019, 1, 1), d(2020, 1, 1), 1000, d(2030, 1, 1)),
        ("2", "主营业务成本.装修费", d(2019, 1, 1), d(2030, 1, 1), 1001, d(2030, 1, 1)),
        ("3", "主营业务成本.装修费（空间设计费）", d(2019, 1, 1), d(2023, 1, 1), None, d(2030, 1, 1)),
        ("4", "other", d(2019, 1, 1), d(2023, 1, 1), 7, d(2030, 1, 1)),
        ("5", "主营业务成本.装修费", d(2019, 1, 31), d(2020, 1, 1), 100, d(2030, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "no string, subject string, s date, e date, amount long, until date")
    out = ap.strategy_expand_months(df, "subject", "s", "e", "amount", "until")
    got = {r.no: (r.n, r.total) for r in out.groupBy("no").agg(F.count("*").alias("n"), F.sum("part").alias("total")).collect()}
    assert got == {"1": (36, 1000), "2": (60, 1001), "3": (48, 0), "4": (1, 7), "5": (36, 100)}
    spans = sorted((r.from_day, r.to_day) for r in out.filter("no = '5'").collect())
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert spans[1] == (d(2019, 2, 28), d(2019, 3, 31))


def test_split_adds_up(spark):
    df = spark.range(97).select(F.lit(1).alias("k"), "id", (F.col("id") % 7 + 1).alias("w"), F.lit(1000).alias("a"))
    for limit in (1, 10):
        out = ap.cumulative_round_split(df, "a", "w", ["k"], ["id"], chunks=limit)
        assert out.agg(F.sum("part")).first()[0] == 1000


def test_nothing_to_split_by(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id int, w long").withColumns({"k": F.lit(1), "a": F.lit(1000)})
    assert [r.part for r in ap.cumulative_round_split(df, "a", "w", ["k"], ["id"]).collect()] == [0, 0]
    df = spark.sql("select 'c' c, 3 n, 0L v, 3 days, 0L total, 'amount' m, array(struct(0.0D as k, 11L as a)) r")
    assert [r.amount for r in ap.share_by_strategy(df, ["c"], "n", "v", "days", "total", "m", "r").collect()] == [0, 0, 0]
