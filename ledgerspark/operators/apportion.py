"""Daily apportionment of fixed, rated and tiered costs.

Every amount depends on a contract's income only through daily sums, so income is added up per
(contract, day) first: a contract's ordered group is then no longer than its calendar, however
many rows it has. Days are generated with ``sequence``, running sums are plain windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import RunningSum, with_running

# Subjects whose income is shared at the second (flat) rate.
SECOND_RATE_SUBJECTS = ("主营业务收入.收入.加液", "主营业务收入.退款.加液")
# Subjects whose cost is spread over months.
MONTHLY_SUBJECTS = ("主营业务成本.装修费", "主营业务成本.装修费（空间设计费）")


def round_half_up(x: Column) -> Column:
    """Nearest whole number, halves towards plus infinity."""
    return F.floor(x + 0.5)


def tiered(amount: Column, tiers: Column) -> Column:
    """Progressive tiers ``array<struct<k double, a bigint>>``: rate k applies above threshold a."""
    parts = F.transform(
        tiers,
        lambda t, i: F.greatest(amount - t.a, F.lit(0)) * (t.k - F.coalesce(F.get(tiers, i - 1).k, F.lit(0.0))),
    )
    return F.aggregate(F.coalesce(parts, F.array().cast("array<double>")), F.lit(0.0), lambda a, b: a + b)


def share_by_strategy(
    df: DataFrame, keys: Sequence[str], day: str, income: str, days: str, total: str, method: str, rates: str
) -> DataFrame:
    """Cumulative amount after each day ``n`` of a contract.

    ``days``, ``total``, ``method`` and ``rates`` are constant per key. Method "days" spreads
    ``rates[0].a`` evenly; "amount" spreads it by income when it is not 0, else applies the tiers.
    Without any income in total there is nothing to spread by: every day has 0 then.
    A row closes the days since the row before it, so the last row must sit on the last day.
    """
    daily = df.groupBy(*keys, day).agg(
        F.coalesce(F.sum(income), F.lit(0)).alias("_income"),
        *[F.max(c).alias(f"_{c}") for c in (days, total, method, rates)],
    )
    w = Window.partitionBy(*keys).orderBy(day)
    before = F.sum("_income").over(w.rowsBetween(Window.unboundedPreceding, -1))
    closed = daily.withColumns(
        {"_from": F.coalesce(F.lag(day).over(w), F.lit(0)), "_pre": F.coalesce(before, F.lit(0))}
    ).filter(F.col("_from") < F.col(day))
    n, amount, pre = F.col("n"), F.col(f"_{rates}")[0]["a"], F.col("_pre")
    by_rate = tiered(pre, F.col(f"_{rates}"))
    value = (
        F.when(F.col(f"_{method}") == "days", round_half_up(amount * F.lit(1.0) * (n + 1) / F.col(f"_{days}")))
        .when(F.col(f"_{method}") != "amount", F.raise_error(F.lit("unknown share method")).cast("bigint"))
        .when(
            amount != 0,
            F.when(pre < 0, 0).otherwise(F.coalesce(round_half_up(F.try_divide(amount * F.lit(1.0) * pre, F.col(f"_{total}"))), F.lit(0))),
        )
        .otherwise(F.signum(by_rate).cast("bigint") * round_half_up(F.abs(by_rate)))
    )
    spread = closed.withColumn("n", F.explode(F.sequence(F.col("_from").cast("int"), F.col(day).cast("int") - 1)))
    return spread.select(*keys, "n", value.cast("bigint").alias("amount"))


def min_of_two_running(df: DataFrame, amount: str, item: str, keys: Sequence[str], order: Sequence[str], **kw) -> DataFrame:
    """Per row, the increase of the smaller of two running sums (items 1 and 2)."""
    which = F.when(F.col(item).isin(1, 2), F.col(item)).otherwise(F.raise_error(F.lit("unknown item")).cast("int"))
    parts = df.withColumns({f"_a{i}": F.when(which == i, F.col(amount)).otherwise(0) for i in (1, 2)})
    run = with_running(parts, keys, order, _c1=RunningSum("_a1"), _c2=RunningSum("_a2"), **kw)
    after = F.least("_c1", "_c2")
    before = F.least(F.col("_c1") - F.col("_a1"), F.col("_c2") - F.col("_a2"))
    return run.withColumn("increase", after - before).select(*df.columns, "increase")


def _daily_income(events: DataFrame, spans: DataFrame, keys: Sequence[str], second: Sequence[str]) -> DataFrame:
    """Per (keys, span, date) from the span's start on: first-rate and second-rate income.

    Days after the start day come from sums per (keys, date). Only rows of the start day itself are
    compared with the start time one by one, in an inner join whose large partitions Spark can split.
    """
    known = F.coalesce(F.col("subject") != "", F.lit(False))
    is_second = F.col("subject").isin(*second)
    rows = events.select(
        *keys,
        "ts",
        F.to_date("ts").alias("date"),
        F.when(known & ~is_second, F.col("income")).alias("_first"),
        F.when(known & is_second, F.col("income")).alias("_second"),
    )
    sums = [F.sum("_first").alias("_first"), F.sum("_second").alias("_second")]
    bounds = spans.select(*keys, "span", "start_ts", F.to_date("start_ts").alias("_start"), F.to_date("end_ts").alias("_end"))
    later = (
        rows.groupBy(*keys, "date")
        .agg(*sums)
        .join(bounds, list(keys))
        .filter((F.col("date") > F.col("_start")) & (F.col("date") < F.col("_end")))
        .select(*keys, "span", "date", "_first", "_second")
    )
    starts = bounds.select(*keys, "span", "start_ts", F.col("_start").alias("date"))
    first_day = (
        rows.join(starts, [*keys, "date"])
        .filter(F.col("ts") >= F.col("start_ts"))
        .groupBy(*keys, "span", "date")
        .agg(*sums)
    )
    return later.unionByName(first_day)


def _by_day(events: DataFrame, spans: DataFrame, keys: Sequence[str], carried: Sequence[str], second: Sequence[str]) -> DataFrame:
    """One row per day of each span with running first-rate and second-rate income, ``carried``
    columns, day number ``i`` and day count ``days``."""
    length = F.datediff("end_ts", "start_ts")
    spans = spans.filter(length > 0)
    grid = spans.select(
        *keys, "span", *carried, length.alias("days"), F.posexplode(F.sequence(F.lit(0), length - 1)).alias("i", "_o"),
        F.to_date("start_ts").alias("_start"),
    )
    empty = F.lit(None).cast("bigint")
    grid = grid.select(
        *keys, "span", F.date_add("_start", F.col("_o")).alias("date"), "i", "days", *carried,
        empty.alias("_first"), empty.alias("_second"),
    )
    income = _daily_income(events, spans, keys, second)
    merged = (
        grid.unionByName(income, allowMissingColumns=True)
        .groupBy(*keys, "span", "date")
        .agg(*[F.max(c).alias(c) for c in ("i", "days", *carried)], F.sum("_first").alias("_f"), F.sum("_second").alias("_s"))
    )
    w = Window.partitionBy(*keys, "span").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return merged.withColumns(
        {"first_sum": F.coalesce(F.sum("_f").over(w), F.lit(0)), "second_sum": F.coalesce(F.sum("_s").over(w), F.lit(0))}
    ).drop("_f", "_s")


def _increase(paid: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys, "span").orderBy("date")
    amount = F.col("_paid") - F.coalesce(F.lag("_paid").over(w), F.lit(0))
    return paid.select(*keys, "span", "date", amount.cast("bigint").alias("amount"))


def _greater_of(by_day: DataFrame, rated: Column) -> DataFrame:
    """Paid so far: the rated share once it reaches the fixed sum, the fixed accrual until then."""
    fixed = F.coalesce(F.col("fixed"), F.lit(0))
    accrued = round_half_up(fixed * F.lit(1.0) / F.col("days") * (F.col("i") + 1))
    share = by_day.withColumn("_share", round_half_up(rated))
    return share.withColumn("_paid", F.when(F.col("_share") < fixed, accrued).otherwise(F.col("_share")))


def fixed_and_ratio_share(
    events: DataFrame, terms: DataFrame, keys: Sequence[str], second: Sequence[str] = SECOND_RATE_SUBJECTS
) -> DataFrame:
    """Daily cost of each contract strategy: fixed accrual or two-rate share, whichever is ahead.

    ``events``: keys, ts, subject, income. ``terms``: keys, span (strategy id), start_ts, end_ts,
    fixed, rate_first, rate_second.
    """
    by_day = _by_day(events, terms, keys, ["fixed", "rate_first", "rate_second"], second)
    zero = F.lit(0.0)
    rated = F.col("first_sum") * F.coalesce("rate_first", zero) + F.col("second_sum") * F.coalesce("rate_second", zero)
    return _increase(_greater_of(by_day, rated), keys)


def guaranteed_min_share(
    events: DataFrame, terms: DataFrame, keys: Sequence[str], second: Sequence[str] = SECOND_RATE_SUBJECTS
) -> DataFrame:
    """As ``fixed_and_ratio_share`` with tiers for the first rate; days without an amount are left out.

    ``terms``: keys, span, start_ts, end_ts, fixed, tiers, rate_second.
    """
    by_day = _by_day(events, terms, keys, ["fixed", "tiers", "rate_second"], second)
    rated = F.col("second_sum") * F.coalesce("rate_second", F.lit(0.0)) + tiered(F.col("first_sum"), F.col("tiers"))
    return _increase(_greater_of(by_day, rated), keys).filter("amount <> 0")


def tiered_share(
    events: DataFrame, terms: DataFrame, keys: Sequence[str], second: Sequence[str] = SECOND_RATE_SUBJECTS
) -> DataFrame:
    """Daily cost by progressive tiers plus a flat second rate; days without an amount are kept.

    ``terms``: keys, start_ts, end_ts, tiers, rate_second. Several rows of one key follow each
    other: each holds from its start day on, while income keeps adding up from the first.
    """
    span = terms.groupBy(*keys).agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
    by_day = _by_day(events, span.withColumn("span", F.lit(0)), keys, [], second)
    rates = terms.groupBy(*keys, F.to_date("start_ts").alias("date")).agg(
        F.max_by(F.struct("tiers", F.coalesce("rate_second", F.lit(0.0)).alias("q")), "start_ts").alias("_r")
    )
    w = Window.partitionBy(*keys, "span").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rated = by_day.join(rates, [*keys, "date"], "left").withColumn("_r", F.last("_r", ignorenulls=True).over(w))
    share = round_half_up(F.col("second_sum") * F.col("_r.q") + tiered(F.col("first_sum"), F.col("_r.tiers")))
    return _increase(rated.withColumn("_paid", share), keys).drop("span")


def whole_years(start: Column, end: Column) -> Column:
    not_reached = (F.month(end) * 100 + F.dayofmonth(end)) < (F.month(start) * 100 + F.dayofmonth(start))
    return F.year(end) - F.year(start) - F.when(not_reached, 1).otherwise(0)


def month_spans(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month: month k runs from start + k months to the next one or to ``end``.

    Months are counted from the start date, so a 31st stays the last day of shorter months only.
    Adds k, from_day, to_day; the dates are computed after the explode, inside generated code.
    """
    months = F.ceil(F.months_between(end, start)).cast("int")
    rows = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.greatest(months, F.lit(0)))))
    spans = rows.withColumns(
        {
            "from_day": F.add_months(start, F.col("k")),
            "to_day": F.least(F.add_months(start, F.col("k") + 1), F.col(end)),
        }
    )
    return spans.filter(F.col("from_day") < F.col(end))


def _given(day: str) -> Column:
    return F.coalesce(F.col(day), F.raise_error(F.lit(f"{day} is missing")).cast("date"))


def strategy_expand_months(
    df: DataFrame, subject: str, start: str, contract_end: str, amount: str, until: str,
    monthly: Sequence[str] = MONTHLY_SUBJECTS,
) -> DataFrame:
    """Costs of the ``monthly`` subjects become one row per month; others keep one row to ``until``.

    The term is 3 years when the contract runs no longer, the contract's own end up to 5 years,
    else 5 years. A month's part is the rounded amount up to its end less that up to its start, so
    the parts add up. Everything is computed inside the row, without a shuffle.
    """
    df = df.withColumns({c: _given(c) for c in (start, contract_end)})
    s, e = F.col(start), F.col(contract_end)
    years = whole_years(s, F.date_sub(F.add_months(e, 12), 1))
    end = F.when(years <= 3, F.add_months(s, 36)).when(years <= 5, e).otherwise(F.add_months(s, 60))
    total = F.coalesce(F.col(amount), F.lit(0))

    def upto(day: str) -> Column:
        return round_half_up(F.lit(1.0) * F.datediff(day, start) / F.datediff("_end", start) * total)

    spread = month_spans(df.filter(F.col(subject).isin(*monthly)).withColumn("_end", end), start, "_end")
    spread = spread.withColumn("part", (upto("to_day") - upto("from_day")).cast("bigint"))
    kept = df.filter(~F.coalesce(F.col(subject).isin(*monthly), F.lit(False))).select(
        "*", s.alias("from_day"), F.col(until).alias("to_day"), total.cast("bigint").alias("part")
    )
    return spread.select(*df.columns, "from_day", "to_day", "part").unionAll(kept)


def cumulative_round_split(
    df: DataFrame, amount: str, weight: str, keys: Sequence[str], order: Sequence[str], **kw
) -> DataFrame:
    """Split ``amount`` (constant per key) by whole-number weights; the parts add up to it exactly.

    Weights that add up to 0 name no shares: all parts are 0 then, whatever the amount.
    """
    totals = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum(weight).alias("_len"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    run = with_running(df, keys, order, _cum=RunningSum(weight), **kw).join(totals, same)

    def upto(cum: Column) -> Column:
        return F.coalesce(round_half_up(F.try_divide(F.lit(1.0) * cum, F.col("_len")) * F.col(amount)), F.lit(0))

    part = upto(F.col("_cum")) - upto(F.col("_cum") - F.coalesce(F.col(weight), F.lit(0)))
    return run.select(*df.columns, part.cast("bigint").alias("part"))
