"""JSON documents, form answers, pages, links and greedy choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import documents as doc
from ledgerspark.functions import html as h
from ledgerspark.operators import forms, greedy
from ledgerspark.operators.links import link_frontier
from ledgerspark.operators.patches import filter_patches
from ledgerspark.plans.registry import query
from ledgerspark.session import cents, spread, table
from ledgerspark.sources.files import local_rows_to_table


def event_document():
    """An event as a JSON object with a nested part, its keys in no order and one number a decimal."""
    who = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("id"), F.lit(2.0).alias("rate"))
    return F.to_json(F.struct(F.col("event_id").alias("id"), who.alias("who")))


@query(
    "json_to_patch",
    """SELECT event_id, '[{"op":"replace","path":"/k","value":' || json_extract_string(props, '$.k') || '}]' AS patch,
         '[{"op":"replace","path":"/id","value":' || event_id || '},{"op":"replace","path":"/who","value":{"type":"' || event_type
         || '","id":' || user_id || ',"rate":2.0}}]' AS nested FROM events""",
)
def json_to_patch(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", doc.json_to_patch(F.col("props")).alias("patch"), doc.json_to_patch(event_document()).alias("nested")
    )


@query(
    "json_set_field",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE
         '{"k":' || json_extract_string(props, '$.k') || ',"who":{"z":1.0,"id":' || user_id || '}}' END AS document,
         '{"k":' || event_id || '}' AS replaced FROM events""",
)
def json_set_field(spark, sf):
    who = F.when(F.col("event_type") != "error", F.to_json(F.struct(F.lit(1.0).alias("z"), F.col("user_id").alias("id"))))
    return table(spark, sf, "events").select(
        "event_id",
        doc.json_set_field(F.col("props"), who, "/who").alias("document"),
        doc.json_set_field(F.col("props"), F.col("event_id").cast("string"), "/k").alias("replaced"),
    )


@query(
    "patch_filter",
    """SELECT event_id, '[{"op":"replace","path":"/who","value":{"id":' || user_id || ',"rate":2.0}}]' AS kept FROM events""",
)
def patch_filter(spark, sf):
    retained = spark.createDataFrame([("/who/rate",), ("/who/id",)], "path string")
    events = spread(table(spark, sf, "events").select("event_id", "event_type", "user_id"))
    patches = events.select("event_id", doc.json_to_patch(event_document()).alias("patch"))
    return filter_patches(patches, ["event_id"], "patch", retained)


@query(
    "build_patch_from_columns",
    """SELECT event_id, '[{"op":"replace","path":"/id","value":"' || event_id || '"},{"op":"replace","path":"/type","value":"'
         || CASE WHEN event_type = 'click' THEN 'input' ELSE 'other' END || '"},{"op":"replace","path":"/active","value":true}]' AS on_patch,
         '[{"op":"remove","path":"/id"},{"op":"replace","path":"/active","value":false}]' AS off_patch FROM events""",
)
def build_patch_from_columns(spark, sf):
    no = F.col("event_id").cast("string")
    kind = F.when(F.col("event_type") == "click", "input").otherwise("other")
    on = doc.build_patch(
        doc.patch_entry("replace", "/id", no), doc.patch_entry("replace", "/type", kind), doc.patch_entry("replace", "/active", F.lit(True))
    )
    off = doc.build_patch(doc.patch_entry("remove", "/id", no), doc.patch_entry("replace", "/active", F.lit(False)))
    return table(spark, sf, "events").select("event_id", on.alias("on_patch"), off.alias("off_patch"))


def order_answers():
    """An order as a JSON array of typed form answers."""

    def answer(no, title, kind, *values, table_rows=None):
        none = F.array().cast(f"array<array<{forms.CELL}>>")
        return F.struct(
            F.lit(no).alias("queId"), F.lit(title).alias("queTitle"), F.lit(kind).alias("queType"),
            F.array(*values).cast(f"array<{forms.VALUE}>").alias("values"),
            (none if table_rows is None else table_rows).alias("tableValues"),
        )

    def value(v, no=None):
        text = v.cast("string")
        empty = F.lit(None).cast("string")
        return F.struct(
            text.alias("value"), (F.lit(None) if no is None else no).cast("int").alias("id"), empty.alias("email"),
            empty.alias("otherInfo"), F.lit(None).cast("int").alias("ordinal"),
        )

    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cell = F.struct(
        F.lit(61).alias("queId"), F.lit("priority").alias("queTitle"), F.lit(2).alias("queType"), F.array(value(F.col("o_orderpriority"))).alias("values")
    ).cast(forms.CELL)
    return F.to_json(
        F.array(
            answer(1, "status", 10, value(F.col("o_orderstatus"))),
            answer(2, "total", 8, value(F.col("o_totalprice").cast("decimal(14,2)"))),
            answer(3, "customer", 5, value(F.lit("C"), F.col("o_custkey") + 1)),
            answer(4, "period", 14, value(F.concat(day, F.lit("~"), day))),
            answer(5, "tags", 12, value(F.col("o_orderstatus")), value(F.col("o_orderpriority"))),
            answer(6, "rows", 18, table_rows=F.array(F.array(cell), F.array(cell))),
        )
    )


@query(
    "form_answer_to_value",
    """SELECT o_orderkey, '{"status":"' || o_orderstatus || '","total":' || CAST(o_totalprice AS DECIMAL(14,2))
         || ',"customer":[{"uid":' || (o_custkey + 1) || ',"name":"C","email":null,"head":null}],"period":["'
         || strftime(o_orderdate, '%Y-%m-%d') || '","' || strftime(o_orderdate, '%Y-%m-%d') || '"],"tags":["' || o_orderstatus || '","'
         || o_orderpriority || '"],"rows":[{"priority":"' || o_orderpriority || '"},{"priority":"' || o_orderpriority || '"}]}' AS document FROM orders""",
)
def form_answer_to_value(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", forms.form_answer_to_value(order_answers()).alias("document"))


FORM = [(0, "c_custkey", 8), (1, "c_name", 2), (2, "segment", 10), (3, "balance", 8), (4, "nation", 5)]


@query(
    "form_row_to_answers",
    """SELECT c_custkey, '[{"queId":1,"values":[{"value":"' || c_name || '"}]}'
         || CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE ',{"queId":2,"values":[{"value":"' || c_mktsegment || '"}]}' END
         || ',{"queId":3,"values":[{"value":"' || CAST(round(c_acctbal * 100) AS BIGINT) || '"}]},{"queId":4,"values":[{"id":' || n_nationkey
         || ',"value":"' || n_name || '"}]}]' AS answers FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def form_row_to_answers(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"),
        cents(F.col("c_acctbal")).alias("balance"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("nation"),
    )
    members = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    return forms.form_row_to_answers(customer, FORM, ["c_custkey"], members)


@query(
    "form_mix_definition",
    """SELECT c_custkey, queId, CASE queId WHEN 1 THEN 'name' WHEN 2 THEN 'segment' WHEN 31 THEN 'balance' END AS queTitle,
         CASE queId WHEN 1 THEN 2 WHEN 2 THEN 10 WHEN 31 THEN 8 END AS queType, v AS value FROM (
         SELECT c_custkey, 1 AS queId, c_name AS v FROM customer UNION ALL SELECT c_custkey, 2, c_mktsegment FROM customer
         UNION ALL SELECT c_custkey, 31, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) FROM customer
         UNION ALL SELECT c_custkey, 99, CAST(c_nationkey AS VARCHAR) FROM customer)""",
)
def form_mix_definition(spark, sf):
    form = local_rows_to_table(
        spark,
        [(1, "name", 2, []), (2, "segment", 10, []), (3, "money", 18, [(31, "balance", 8)])],
        "queId int, queTitle string, queType int, subQuestionBaseInfos array<struct<queId:int,queTitle:string,queType:int>>",
    )
    values = {
        1: F.col("c_name"), 2: F.col("c_mktsegment"), 31: cents(F.col("c_acctbal")).cast("string"), 99: F.col("c_nationkey").cast("string"),
    }
    answers = F.array(*[F.struct(F.lit(k).alias("queId"), v.alias("value")) for k, v in values.items()])
    long = table(spark, sf, "customer").select("c_custkey", F.inline(answers))
    return forms.form_mix_definition(long, form)


@query(
    "answer_get_by_title",
    """SELECT o_orderkey, o_orderstatus AS status, o_custkey AS customer, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def answer_get_by_title(spark, sf):
    named = F.to_json(
        F.array(
            F.struct(F.lit(0).alias("queId"), F.lit("customer").alias("queTitle"), F.array(F.struct(F.lit("-1").alias("value"))).alias("values")),
            *[
                F.struct(F.lit(i).alias("queId"), F.lit(t).alias("queTitle"), F.array(F.struct(v.cast("string").alias("value"))).alias("values"))
                for i, (t, v) in enumerate(
                    (("status", F.col("o_orderstatus")), ("customer", F.col("o_custkey")), ("day", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))), 1
                )
            ],
        )
    )
    orders = table(spark, sf, "orders").select("o_orderkey", forms.parse_answers(named).alias("a"))
    return orders.select(
        "o_orderkey",
        forms.answer_get_by_title(F.col("a"), "status").alias("status"),
        forms.answer_get_by_title(F.col("a"), "customer", "long").alias("customer"),
        F.date_format(forms.answer_get_by_title(F.col("a"), "day", "timestamp"), "yyyy-MM-dd").alias("day"),
    )


def order_page():
    """A page with a table of one order: its key on the row, a unit in a head, a switch in a cell."""
    head = "<tr><td>订单号</td><td>金额(元)</td><td style=\"display:none;\">x</td><td> 状态 </td><td>开关</td></tr>"
    switch = F.when(F.col("o_orderstatus") == "F", '<span class="btn switch-on"></span>').when(
        F.col("o_orderstatus") == "O", "<span class='switch-off'></span>"
    )
    return F.concat(
        F.lit(f"<html><table class=\"list\"><thead>{head}</thead>\n<tbody><tr class=\"r\" data-key=\""), F.col("o_custkey").cast("string"),
        F.lit("\"><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td><b>"), F.col("o_totalprice").cast("decimal(14,2)").cast("string"),
        F.lit("</b></td><td> A&amp;"), "o_orderpriority", F.lit("\n</td><td>"), F.coalesce(switch, F.lit("-")), F.lit("</td></tr></tbody></table></html>"),
    )


def order_pages(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return spread(rows).select("o_orderkey", order_page().alias("html"))


@query(
    "html_table_rows",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS row_key, CAST(o_orderkey AS VARCHAR) AS no,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS amount, 'A&' || o_orderpriority AS status FROM orders""",
)
def html_table_rows(spark, sf):
    pages = order_pages(spark, sf)
    rows = h.html_table_rows(pages, "html", "o_orderkey")
    cell = {"no": "订单号", "amount": "金额", "status": "状态"}
    return rows.select("o_orderkey", "row_key", *[h.inner_text(F.col("cells")[c]).alias(n) for n, c in cell.items()])


@query(
    "html_switch_flags",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag FROM orders",
)
def html_switch_flags(spark, sf):
    pages = order_pages(spark, sf)
    return h.html_table_rows(pages, "html", "o_orderkey").select("o_orderkey", h.switch_flag(F.col("cells")["开关"]).alias("flag"))


def text_sql(fragment: str) -> str:
    plain = f"regexp_replace(regexp_replace({fragment}, '(?i)<br\\s*/?>', ' ', 'g'), '(?s)<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        quoted = char.replace("'", "''")
        plain = f"replace({plain}, '{entity}', '{quoted}')"
    return f"trim(regexp_replace({plain}, '\\s+', ' ', 'g'))"


@query(
    "html_title_and_selectors",
    rf"""SELECT page_id, {text_sql(r"regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)")} AS title,
          {text_sql(r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)")} AS h1,
          CAST(len(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1)) AS INTEGER) AS items,
          array_to_string(list_transform(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1), lambda x: {text_sql('x')}), '|') AS item_texts,
          {text_sql(r"regexp_extract(html, '(?is)<div class=.ad.>(.*?)</div\s*>', 1)")} AS ad
        FROM pages""",
)
def html_title_and_selectors(spark, sf):
    found = h.select(F.col("html"), title="head > title", h1="article h1", items="ul > li", ad="div.ad")
    pages = table(spark, sf, "pages").select("page_id", found.alias("s"))

    def first(name):
        return F.coalesce(F.get(f"s.{name}", F.lit(0))["text"], F.lit("")).alias(name)

    items = F.col("s.items")
    return pages.select(
        "page_id", first("title"), first("h1"), F.size(items).alias("items"), F.array_join(h.texts(items), "|").alias("item_texts"), first("ad")
    )


@query(
    "html_links",
    r"""WITH l AS (SELECT url AS src, regexp_extract(url, '^((?:https?://)?[^/\s]*)', 1) AS host,
            unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS raw FROM pages),
          u AS (SELECT src, host, replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t FROM l),
          a AS (SELECT src, host, regexp_replace(CASE WHEN starts_with(t, 'http') THEN t WHEN starts_with(t, '/') THEN host || t ELSE host || '/' || t END, '/$', '') AS dst FROM u)
        SELECT DISTINCT src, dst FROM a WHERE starts_with(dst, host)""",
)
def html_links(spark, sf):
    return h.html_links(table(spark, sf, "pages"), "url", "html")


def supply_links(spark, sf):
    """Suppliers and the parts they ship, linked both ways."""
    pairs = table(spark, sf, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("s"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("p")
    ).distinct()
    return pairs.select(F.col("s").alias("src"), F.col("p").alias("dst")).unionAll(pairs.select("p", "s"))


@query(
    "link_frontier",
    """WITH RECURSIVE e AS (SELECT DISTINCT 's' || l_suppkey AS s, 'p' || l_partkey AS p FROM lineitem),
         l AS (SELECT s AS src, p AS dst FROM e UNION ALL SELECT p, s FROM e),
         r AS (SELECT 's0' AS node UNION SELECT l.dst FROM l JOIN r ON l.src = r.node) SELECT node FROM r""",
)
def link_frontier_query(spark, sf):
    supplier = table(spark, sf, "supplier").filter("s_suppkey = 0")
    seeds = supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("node"))
    return link_frontier(supply_links(spark, sf), seeds).select("node")


@query(
    "html_images",
    """SELECT page_id, CAST(0 AS INTEGER) AS nth, '/img/' || page_id || '.png' AS src, 'page ' || page_id AS alt FROM pages
       UNION ALL SELECT page_id, 1, url, '' FROM pages""",
)
def html_images(spark, sf):
    # the pages have no images, so each gets two in its markup
    no = F.col("page_id").cast("string")
    html = F.concat(
        "html", F.lit('<p><img src="/img/'), no, F.lit('.png" alt="page '), no, F.lit("\"><img class='x' alt='' src='"),
        F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("'/></p>"),
    )
    return h.html_images(table(spark, sf, "pages").select("page_id", html.alias("html")), "html", "page_id")


@query(
    "pager_parse",
    """SELECT o_custkey, CAST(count(*) AS INTEGER) AS total, 1 AS page, CAST(ceil(count(*) / 10.0) AS INTEGER) AS last, true AS complete
       FROM orders GROUP BY o_custkey""",
)
def pager_parse(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    last = F.ceil(F.col("n") / 10).cast("string")
    line = F.concat(F.lit(" 共"), F.col("n").cast("string"), F.lit("条记录 当前页 1/"), last)
    return counted.select("o_custkey", "n", h.pager(line).alias("p")).select("o_custkey", "p.*", (F.col("p.total") == F.col("n")).alias("complete"))


@query(
    "interval_schedule",
    """WITH RECURSIVE i AS (SELECT l_suppkey, o_orderdate AS s, l_shipdate AS e FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
         b AS (SELECT l_suppkey, e, max(s) FILTER (s < e) AS s, count(*) FILTER (s = e) AS z FROM i WHERE s <= e GROUP BY 1, 2),
         g AS (SELECT DISTINCT l_suppkey, TIMESTAMP '0001-01-01' AS e, 0::BIGINT AS n FROM i
               UNION ALL
               SELECT g.l_suppkey, min(b.e), n + arg_min(CASE WHEN b.s >= g.e THEN 1 ELSE 0 END + b.z, b.e)
               FROM g JOIN b ON b.l_suppkey = g.l_suppkey AND b.e > g.e AND (b.s >= g.e OR b.z > 0) GROUP BY g.l_suppkey, n)
       SELECT l_suppkey, count(*) - (SELECT max(n) FROM g WHERE g.l_suppkey = i.l_suppkey) AS removed FROM i GROUP BY l_suppkey""",
)
def interval_schedule(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    spans = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return greedy.interval_schedule(spans, ["l_suppkey"], "o_orderdate", "l_shipdate")


@query(
    "greedy_assignment",
    """WITH v AS (SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 100) AS BIGINT) AS v, 1 AS r, 0 AS s FROM customer
             UNION ALL SELECT s_nationkey, CAST(floor(s_acctbal / 100) AS BIGINT), 0, 1 FROM supplier),
         c AS (SELECT nation, v, sum(r) AS r, sum(s) AS s FROM v GROUP BY 1, 2),
         t AS (SELECT *, sum(r - s) OVER (PARTITION BY nation ORDER BY v DESC) AS short FROM c)
       SELECT nation, CAST(sum(r) AS BIGINT) AS requests, CAST(sum(r) - greatest(max(short), 0) AS BIGINT) AS met FROM t GROUP BY nation""",
)
def greedy_assignment(spark, sf):
    requests = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 100).alias("need"))
    supplies = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 100).alias("size"))
    return greedy.greedy_assignment(requests, supplies, ["nation"], "need", "size")
