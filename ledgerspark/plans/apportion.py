"""Daily apportionment of contract costs over the event stream, one contract per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import apportion as ap
from ledgerspark.plans.registry import query
from ledgerspark.session import cents, stored, table

MONTH_START, MONTH_END = "2024-01-01", "2024-01-31"
OTHER_SUBJECT = "主营业务收入.收入.X"
TIERS = ((0.5, 0), (0.6, 5000), (0.7, 20000))


def income_events(spark, sf):
    kind = F.col("event_type")
    subject = F.when(kind == "purchase", ap.SECOND_RATE_SUBJECTS[0]).when(kind != "error", OTHER_SUBJECT)
    return table(spark, sf, "events").select(
        "user_id", "ts", "event_id", "event_type", subject.alias("subject"), cents(F.col("value")).alias("income")
    )


EVENTS_SQL = f"""ev AS (SELECT user_id, ts, event_id, event_type, CAST(round(value * 100) AS BIGINT) AS income,
      CASE WHEN event_type = 'purchase' THEN '{ap.SECOND_RATE_SUBJECTS[0]}'
           WHEN event_type <> 'error' THEN '{OTHER_SUBJECT}' END AS subject FROM events)"""


def tier_array(tiers):
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).cast("bigint").alias("a")) for k, a in tiers])


def tier_sql(amount, tiers):
    """0 + max(0, amount - a) * (k - previous k) + ..., in doubles."""
    parts, previous = ["0e0"], 0.0
    for k, a in tiers:
        parts.append(f"greatest({amount} - {a}, 0) * ({k}e0 - {previous}e0)")
        previous = k
    return "(" + " + ".join(parts) + ")"


def contract(events):
    """One term per user: from its first event to the end of the month. Terms are a table of their
    own, read several times, so they are stored."""
    terms = events.groupBy("user_id").agg(
        F.min("ts").alias("start_ts"),
        F.lit(MONTH_END).cast("timestamp_ntz").alias("end_ts"),
        (F.max("income") * 2).alias("fixed"),
    )
    return stored(terms, "terms")


def running_sql(terms: str, rated: str, fixed: str = "fixed") -> str:
    """Paid amounts per (user, span, day): ``terms`` gives user_id, span, s, e and the terms' columns."""
    return f"""WITH {EVENTS_SQL}, terms AS ({terms}),
      grid AS (SELECT *, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS date,
                 date_diff('day', CAST(s AS DATE), CAST(e AS DATE)) AS days FROM terms),
      inc AS (SELECT t.user_id, t.span, CAST(ev.ts AS DATE) AS date,
                sum(CASE WHEN subject = '{ap.SECOND_RATE_SUBJECTS[0]}' THEN income END) AS l,
                sum(CASE WHEN subject = '{OTHER_SUBJECT}' THEN income END) AS n
              FROM ev JOIN terms t ON ev.user_id = t.user_id AND ev.ts >= t.s GROUP BY 1, 2, 3),
      run AS (SELECT g.*, CAST(sum(coalesce(inc.l, 0)) OVER w AS DOUBLE) AS second_sum,
                CAST(sum(coalesce(inc.n, 0)) OVER w AS DOUBLE) AS first_sum, row_number() OVER w AS nth
              FROM grid g LEFT JOIN inc ON inc.user_id = g.user_id AND inc.span = g.span AND inc.date = g.date
              WINDOW w AS (PARTITION BY g.user_id, g.span ORDER BY g.date)),
      shares AS (SELECT *, floor({rated} + 0.5e0) AS share FROM run),
      paid AS (SELECT *, CASE WHEN share < {fixed} THEN floor(CAST({fixed} AS DOUBLE) / days * nth + 0.5e0) ELSE share END AS paid
               FROM shares),
      steps AS (SELECT user_id, span, CAST(date AS VARCHAR) AS date,
                  CAST(paid - coalesce(lag(paid) OVER (PARTITION BY user_id, span ORDER BY date), 0) AS BIGINT) AS amount
                FROM paid)"""


@query(
    "share_by_strategy",
    f"""WITH {EVENTS_SQL}, base AS (
         SELECT user_id, date_diff('day', DATE '{MONTH_START}', CAST(ts AS DATE)) AS day,
           CASE WHEN user_id % 10 = 0 THEN 0 ELSE income END AS income FROM ev
         UNION ALL SELECT DISTINCT user_id, date_diff('day', DATE '{MONTH_START}', DATE '{MONTH_END}'), 0 FROM ev),
       daily AS (SELECT user_id, day, sum(income) AS income FROM base GROUP BY 1, 2),
       run AS (SELECT user_id, day, coalesce(lag(day) OVER w, 0) AS since,
                 coalesce(sum(income) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre,
                 sum(income) OVER (PARTITION BY user_id) AS total FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day)),
       spread AS (SELECT user_id, CAST(unnest(generate_series(since, day - 1)) AS INTEGER) AS n, CAST(pre AS DOUBLE) AS pre,
                    CAST(total AS DOUBLE) AS total, date_diff('day', DATE '{MONTH_START}', DATE '{MONTH_END}') AS days
                  FROM run WHERE since < day)
       SELECT user_id, 'by days' AS strategy, n, CAST(floor(1100e0 * (n + 1) / days + 0.5e0) AS BIGINT) AS amount FROM spread
       UNION ALL
       SELECT user_id, 'by income', n, CAST(coalesce(floor(-1100e0 * pre / nullif(total, 0) + 0.5e0), 0) AS BIGINT) FROM spread
       UNION ALL
       SELECT user_id, 'by tiers', n, CAST(floor({tier_sql('pre', TIERS)} + 0.5e0) AS BIGINT) FROM spread""",
)
def share_by_strategy(spark, sf):
    events = income_events(spark, sf)
    days = F.datediff(F.lit(MONTH_END), F.lit(MONTH_START))
    # some contracts earn nothing at all
    income = F.when(F.col("user_id") % 10 == 0, 0).otherwise(F.col("income")).cast("bigint").alias("income")
    rows = events.select("user_id", F.datediff("ts", F.lit(MONTH_START)).alias("day"), income)
    # a contract's closing row sits on the last day
    closing = events.select("user_id").distinct().select("user_id", days.alias("day"), F.lit(0).cast("bigint").alias("income"))
    daily = rows.unionByName(closing).groupBy("user_id", "day").agg(F.sum("income").alias("income"))
    totals = daily.groupBy("user_id").agg(F.sum("income").alias("total"))
    strategies = F.array(
        *[
            F.struct(F.lit(name).alias("strategy"), F.lit(method).alias("method"), tier_array(tiers).alias("rates"))
            for name, method, tiers in (
                ("by days", "days", ((0.0, 1100),)),
                ("by income", "amount", ((0.0, -1100),)),
                ("by tiers", "amount", TIERS),
            )
        ]
    )
    rated = daily.join(totals, "user_id").select("*", days.alias("days"), F.inline(strategies))
    return ap.share_by_strategy(rated, ["user_id", "strategy"], "day", "income", "days", "total", "method", "rates")


@query(
    "min_of_two_running",
    f"""WITH {EVENTS_SQL}, run AS (
         SELECT user_id, event_id, income, event_type IN ('purchase', 'signup') AS first_item,
           sum(CASE WHEN event_type IN ('purchase', 'signup') THEN income ELSE 0 END) OVER w AS c1,
           sum(CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE income END) OVER w AS c2
         FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
       SELECT user_id, event_id, CAST(least(c1, c2) - least(CASE WHEN first_item THEN c1 - income ELSE c1 END,
                CASE WHEN first_item THEN c2 ELSE c2 - income END) AS BIGINT) AS increase FROM run""",
)
def min_of_two_running(spark, sf):
    item = F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(2)
    events = income_events(spark, sf).select("user_id", "ts", "event_id", "income", item.alias("item"))
    out = ap.min_of_two_running(events, "income", "item", ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "increase")


TWO_SPANS = f"""SELECT user_id, 0 AS span, min(ts) AS s, TIMESTAMP '{MONTH_END}' AS e, max(income) * 2 AS fixed, 0e0 AS p, 0e0 AS q
        FROM ev GROUP BY user_id
      UNION ALL SELECT user_id, 1, min(ts), TIMESTAMP '{MONTH_END}', max(income) * 2, 0.4e0, 0.8e0 FROM ev GROUP BY user_id"""


@query(
    "fixed_and_ratio_share",
    running_sql(TWO_SPANS, "first_sum * p + second_sum * q") + " SELECT user_id, span, date, amount FROM steps",
)
def fixed_and_ratio_share(spark, sf):
    events = income_events(spark, sf)
    spans = F.array(
        *[
            F.struct(F.lit(i).alias("span"), F.lit(p).cast("double").alias("rate_first"), F.lit(q).cast("double").alias("rate_second"))
            for i, (p, q) in enumerate(((None, None), (0.4, 0.8)))
        ]
    )
    terms = contract(events).select("*", F.inline(spans))
    out = ap.fixed_and_ratio_share(events, terms, ["user_id"])
    return out.withColumn("date", F.col("date").cast("string"))


ONE_SPAN = f"SELECT user_id, 0 AS span, min(ts) AS s, TIMESTAMP '{MONTH_END}' AS e, max(income) * 2 AS fixed FROM ev GROUP BY user_id"
RATED = f"second_sum * 0.3e0 + {tier_sql('first_sum', TIERS)}"


@query(
    "guaranteed_min_share",
    running_sql(ONE_SPAN, RATED) + " SELECT user_id, date, amount FROM steps WHERE amount <> 0",
)
def guaranteed_min_share(spark, sf):
    events = income_events(spark, sf)
    terms = contract(events).select(
        "*", F.lit(0).alias("span"), tier_array(TIERS).alias("tiers"), F.lit(0.3).alias("rate_second")
    )
    out = ap.guaranteed_min_share(events, terms, ["user_id"])
    return out.select("user_id", F.col("date").cast("string").alias("date"), "amount")


LATER_TIERS = ((0.2, 0), (0.9, 30000))
CHANGE_DAY = "2024-01-15"


@query(
    "tiered_share",
    running_sql(
        ONE_SPAN.replace("FROM ev GROUP BY user_id", f", min(ts) < TIMESTAMP '{CHANGE_DAY}' AS starts_early FROM ev GROUP BY user_id"),
        f"""CASE WHEN date < DATE '{CHANGE_DAY}' THEN {RATED}
            ELSE second_sum * 0.1e0 + {tier_sql('first_sum', LATER_TIERS)} END""",
        fixed="0",
    ).replace("CASE WHEN share < 0 THEN floor(CAST(0 AS DOUBLE) / days * nth + 0.5e0) ELSE share END", "share")
    + " SELECT user_id, date, amount FROM steps",
)
def tiered_share(spark, sf):
    events = income_events(spark, sf)
    terms = contract(events)
    first = terms.select("user_id", "start_ts", "end_ts", tier_array(TIERS).alias("tiers"), F.lit(0.3).alias("rate_second"))
    # a contract that starts after the change has the later rates from its first day
    change = F.lit(CHANGE_DAY).cast("timestamp_ntz")
    later = F.when(F.col("start_ts") >= change, F.expr("start_ts + interval 1 microsecond")).otherwise(change)
    second = terms.select(
        "user_id", later.alias("start_ts"), "end_ts", tier_array(LATER_TIERS).alias("tiers"), F.lit(0.1).alias("rate_second")
    )
    out = ap.tiered_share(events, first.unionByName(second), ["user_id"])
    return out.withColumn("date", F.col("date").cast("string"))


def order_contracts(spark, sf):
    """Orders as contracts: urgent and high orders are spread monthly, larger ones run longer."""
    day = F.to_date("o_orderdate")
    subject = F.when(F.col("o_orderpriority") == "1-URGENT", ap.MONTHLY_SUBJECTS[0]).when(
        F.col("o_orderpriority") == "2-HIGH", ap.MONTHLY_SUBJECTS[1]
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(subject, F.lit("other")).alias("subject"),
        day.alias("start_day"),
        F.date_add(day, F.floor(F.col("o_totalprice") / 200).cast("int")).alias("contract_end"),
        cents(F.col("o_totalprice")).alias("amount"),
        F.lit("2030-01-01").cast("date").alias("until"),
    )


@query(
    "strategy_expand_months",
    """WITH c AS (SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS monthly, CAST(o_orderdate AS DATE) AS s,
            CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 200) AS INTEGER) AS e,
            CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders),
          y AS (SELECT *, CAST(e + INTERVAL 12 MONTH AS DATE) - 1 AS e1 FROM c),
          t AS (SELECT *, year(e1) - year(s) - CASE WHEN month(e1) * 100 + day(e1) < month(s) * 100 + day(s) THEN 1 ELSE 0 END AS years FROM y),
          z AS (SELECT *, CAST(CASE WHEN years <= 3 THEN s + INTERVAL 36 MONTH WHEN years <= 5 THEN e ELSE s + INTERVAL 60 MONTH END AS DATE) AS stop FROM t),
          m AS (SELECT *, unnest(range(0, 62)) AS k FROM z WHERE monthly),
          spans AS (SELECT *, CAST(s + to_months(CAST(k AS INTEGER)) AS DATE) AS f,
                      least(CAST(s + to_months(CAST(k + 1 AS INTEGER)) AS DATE), stop) AS t FROM m)
       SELECT o_orderkey, CAST(f AS VARCHAR) AS from_day, CAST(t AS VARCHAR) AS to_day,
         CAST(floor(CAST(date_diff('day', s, t) AS DOUBLE) / date_diff('day', s, stop) * amount + 0.5e0)
            - floor(CAST(date_diff('day', s, f) AS DOUBLE) / date_diff('day', s, stop) * amount + 0.5e0) AS BIGINT) AS part
       FROM spans WHERE f < stop
       UNION ALL SELECT o_orderkey, CAST(s AS VARCHAR), '2030-01-01', amount FROM c WHERE NOT monthly""",
)
def strategy_expand_months(spark, sf):
    out = ap.strategy_expand_months(order_contracts(spark, sf), "subject", "start_day", "contract_end", "amount", "until")
    return out.select("o_orderkey", F.col("from_day").cast("string"), F.col("to_day").cast("string"), "part")


@query(
    "cumulative_round_split",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
            CASE WHEN l_orderkey % 10 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS w, CAST(round(o_totalprice * 100) AS BIGINT) AS amount
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
          r AS (SELECT *, sum(w) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, price
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, sum(w) OVER (PARTITION BY l_orderkey) AS len FROM l)
       SELECT l_orderkey, l_linenumber, l_partkey, CAST(coalesce(floor(CAST(cum AS DOUBLE) / nullif(len, 0) * amount + 0.5e0)
                - floor(CAST(cum - w AS DOUBLE) / nullif(len, 0) * amount + 0.5e0), 0) AS BIGINT) AS part FROM r""",
)
def cumulative_round_split(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), cents(F.col("o_totalprice")).alias("amount")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents(F.col("l_extendedprice")).alias("price"),
        # some orders have no weights at all
        F.when(F.col("l_orderkey") % 10 == 0, 0).otherwise(F.col("l_quantity").cast("bigint")).alias("w"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "price"]
    out = ap.cumulative_round_split(lines.join(orders, "l_orderkey"), "amount", "w", ["l_orderkey"], order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "part")


@query(
    "date_series_days",
    """SELECT user_id, CAST(CAST(unnest(generate_series(f, t - 1, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS day
       FROM (SELECT user_id, CAST(min(ts) AS DATE) AS f, CAST(max(ts) AS DATE) AS t FROM events GROUP BY 1) WHERE f < t""",
)
def date_series_days(spark, sf):
    bounds = table(spark, sf, "events").groupBy("user_id").agg(
        F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")
    )
    days = F.explode(F.sequence("first", F.date_sub("last", 1), F.expr("interval 1 day")))
    return bounds.filter("first < last").select("user_id", days.alias("day")).withColumn("day", F.col("day").cast("string"))


@query(
    "date_series_months",
    """SELECT o_custkey, CAST(k AS INTEGER) AS k, CAST(f AS VARCHAR) AS from_day, CAST(t AS VARCHAR) AS to_day FROM (
         SELECT o_custkey, k, stop, CAST(s + to_months(CAST(k AS INTEGER)) AS DATE) AS f,
           least(CAST(s + to_months(CAST(k + 1 AS INTEGER)) AS DATE), stop) AS t
         FROM (SELECT *, unnest(range(0, date_diff('month', s, stop) + 2)) AS k FROM (
           SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS stop FROM orders GROUP BY 1)))
       WHERE f < stop""",
)
def date_series_months(spark, sf):
    bounds = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    spans = ap.month_spans(bounds, "first", "last")
    return spans.select("o_custkey", "k", *[F.col(c).cast("string").alias(c) for c in ("from_day", "to_day")])
