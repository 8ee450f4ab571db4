"""Expected values of scalar, document and HTML functions."""

import datetime as dt
import json
import weakref

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerspark.functions import documents as doc
from ledgerspark.functions import html as h
from ledgerspark.functions import scalars as sc
from ledgerspark.operators import forms, greedy
from ledgerspark.operators import aggregates as agg
from ledgerspark.operators import relational as rel
from ledgerspark.operators import windows as win
from ledgerspark.operators.links import link_frontier


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return df.select(column.alias("out")).first().out


PLACE = {"zip": 150, "city": "Oslo", "geo": {"lon": 10.75, "lat": 59.9, "src": "gps"}}


def keep(spark, patch, *paths):
    return json.loads(one(spark, doc.patch_filter(F.col("p"), *paths), p=json.dumps(patch)))


def test_patch_filter_objects(spark):
    """What is kept of a whole object depends on where it is put and which paths are retained."""
    moved = [{"op": "replace", "path": p, "value": PLACE} for p in ("/home", "/homes", "")]
    values = lambda *paths: [e["value"] for e in keep(spark, moved, *paths)]
    assert values("/home/city") == [{"city": "Oslo"}]
    assert values("/home/geo", "/home/geo/lat") == [{"geo": {"lat": 59.9}}]
    assert values("/home/zip", "/home/geo/src") == [{"zip": 150, "geo": {"src": "gps"}}]
    assert values("/zip") == [{"zip": 150}]
    assert values("/hom", "/home/none", "/homecity") == []
    assert values("/home") == [PLACE] == values("/home", "/hom")
    deep = [{"op": "add", "path": "/person/home", "value": PLACE}]
    assert keep(spark, deep, "/person") == deep
    assert keep(spark, deep, "/person/home/geo/lon", "/person/home/geo/src")[0]["value"] == {"geo": {"lon": 10.75, "src": "gps"}}
    assert keep(spark, [{"op": "add", "path": "", "value": PLACE}], "/geo/lat", "/geo") == [
        {"op": "add", "path": "", "value": {"geo": {"lat": 59.9}}}
    ]


def test_patch_filter_remove_and_plain(spark):
    gone = [{"op": "remove", "path": p} for p in ("/phone", "/home/city", "/home/geo/lat", "/homes/city")]
    assert [e["path"] for e in keep(spark, gone, "/home")] == ["/home/city", "/home/geo/lat"]
    assert [e["path"] for e in keep(spark, gone, "/phone/mobile")] == ["/phone"]
    plain = [{"op": "replace", "path": p, "value": v} for p, v in (("/home/city", "Rome"), ("/home/zip", 184), ("/work/city", "Bari"))]
    assert [e["value"] for e in keep(spark, plain, "/home/city")] == ["Rome"]
    assert [e["value"] for e in keep(spark, plain, "/home")] == ["Rome", 184]
    assert keep(spark, plain, "/home/city/name") == []
    with pytest.raises(Exception, match="not supported"):
        keep(spark, [{"op": "copy", "path": "/a"}], "/a")


def test_json_documents_keep_order_and_number_kind(spark):
    text = '{"y":{"b":2.0,"a":[1,{"z":1.5,"c":null}]},"s":"q\\"\\n","t":true,"k/x~":"1"}'
    assert one(spark, doc.json_set_field(F.col("p"), F.lit('{"q":2.0,"a":1}'), "/t"), p=text) == text.replace("true", '{"q":2.0,"a":1}')
    patch = one(spark, doc.json_to_patch(F.col("p")), p=text)
    assert patch.startswith('[{"op":"replace","path":"/y","value":{"b":2.0,"a":[1,{"z":1.5,"c":null}]}},')
    assert one(spark, doc.json_to_patch(F.col("p")), p="{}") == "[]"
    escaped = '[{"op":"add","path":"","value":{"k/x~":{"m":2.0,"a":1},"o":1}},{"op":"remove","path":"/k~1x~0"}]'
    assert one(spark, doc.patch_filter(F.col("p"), "/k~1x~0/m"), p=escaped) == escaped.replace(',"a":1}', "}").replace(',"o":1', "")
    with pytest.raises(Exception, match="not supported"):
        one(spark, doc.patch_filter(F.col("p"), "/a"), p='[{"op":"move","path":"/a","value":1}]')


def test_json_documents(spark):
    patch = json.loads(one(spark, doc.json_to_patch(F.col("p")), p='{"a":1,"b":{"c":[1,"x"]},"d":null}'))
    assert patch == [
        {"op": "replace", "path": "/a", "value": 1}, {"op": "replace", "path": "/b", "value": {"c": [1, "x"]}},
        {"op": "replace", "path": "/d", "value": None},
    ]
    put = lambda a, b, path: one(spark, doc.json_set_field(F.col("a"), F.col("b"), path), a=a, b=b)
    assert json.loads(put('{"a":1,"b":2}', '{"x":[1]}', "/a")) == {"a": {"x": [1]}, "b": 2}
    assert json.loads(put('{"a":1}', '"t"', "/n")) == {"a": 1, "n": "t"}
    assert put('{"a":1}', None, "/a") == '{"a":1}'
    assert put(None, "1", "/a") is None
    built = doc.build_patch(doc.patch_entry("remove", "/id", F.lit("7")), doc.patch_entry("replace", "/active", F.lit(True)))
    assert json.loads(one(spark, built)) == [{"op": "remove", "path": "/id"}, {"op": "replace", "path": "/active", "value": True}]
    assert one(spark, sc.json_point_at(F.col("p"), "/a/1/b"), p='{"a":[1,{"b":"x"}]}') == "x"


TEXT = (
    "合同按年结算，逾期另议。\n三号楼已停用。\n"
    "截止2023-04-30，每年费用1200.00元。（冰柜5台+2台=7台）\n"
    "截止2024-10-31，每年费用987.65元。（冰柜6台+1台=7台）"
)


def test_clauses(spark):
    parts = [p.replace("\n", "") for p in one(spark, sc.split_keep_delimiter(F.col("t"), sc.CLAUSE), t=TEXT)]
    assert len(parts) == 3 and parts[2] == ""
    assert parts[0].startswith("合同") and parts[0].endswith("截止2023-04-30，每年费用1200.00元。（冰柜5台+2台=7台）")
    assert parts[1] == "截止2024-10-31，每年费用987.65元。（冰柜6台+1台=7台）"
    found = sc.extract_clauses(spark.createDataFrame([(TEXT,)], "t string"), "t").orderBy("offset").collect()
    assert [(c.date, c.amount) for c in found] == [("2023-04-30", "1200.00"), ("2024-10-31", "987.65")]
    assert [c.offset for c in found] == [i for i in range(len(TEXT)) if TEXT.startswith("截止", i)]
    marked = "a\u0001b;c"
    assert one(spark, sc.split_keep_delimiter(F.col("t"), ";"), t=marked) == ["a\u0001b;", "c"]


def test_bits_and_codes(spark):
    for x in (-9, -7, 0, 3, 2**40):
        col = F.lit(x).cast("bigint")
        assert one(spark, sc.abs_by_bits(col)) == abs(x)
        assert one(spark, sc.negate_by_bits(col)) == -x
        assert one(spark, sc.is_odd(col)) == bool(x % 2)
    assert one(spark, sc.lookup(sc.REGION_TYPES, F.lit(2))) == "市"
    assert one(spark, sc.lookup(sc.REGION_TYPES, F.lit(None).cast("int"))) is None
    assert one(spark, sc.split_trim_omit(F.col("t")), t=" a, ,b ,,c") == ["a", "b", "c"]


def test_snowflake_overflow(spark):
    """Ids equal those of a generator that waits for the next millisecond when one is full."""
    times = sorted([0] * 5000 + [1] * 3 + [5] * 4097 + [6])
    df = spark.createDataFrame([(i, t + sc.ID_EPOCH_MS) for i, t in enumerate(times)], "n long, ms long")
    df = df.select("n", F.timestamp_millis("ms").alias("ts"), F.lit(3).alias("w"), F.lit(2).alias("dc"))
    want, last, seq = [], -1, 0
    for t in times:
        t = max(t, last)
        seq = seq + 1 if t == last else 0
        if seq == 4096:
            t, seq = t + 1, 0
        last = t
        want.append(t << 22 | 2 << 17 | 3 << 12 | seq)
    for limit in (1, 7):
        out = sc.snowflake_ids(df, "ts", "w", "dc", "n", chunks=limit).orderBy("n").collect()
        assert [r.id for r in out] == want


TABLE = """<table class="t"><thead><tr><td>编号</td><td>金额(元)</td><td style="display:none;">x</td><td>开关</td></tr></thead>
<tbody><tr data-key="7"><td> N1 </td><td><b>3.5</b>0</td><td><span class="b switch-on"></span></td></tr>
<tr class="odd" data-key='8'><td>A&amp;B</td><td>1<br/>2</td><td><i>-</i></td></tr></tbody></table>"""


def test_html_table(spark):
    page = spark.createDataFrame([(1, TABLE)], "id int, html string")
    rows = h.html_table_rows(page, "html", "id").select(
        "row_key", h.inner_text(F.col("cells")["编号"]).alias("no"), h.inner_text(F.col("cells")["金额"]).alias("amount"),
        h.switch_flag(F.col("cells")["开关"]).alias("on"),
    )
    assert sorted(map(tuple, rows.collect())) == [("7", "N1", "3.50", True), ("8", "A&B", "1 2", None)]
    broken = spark.createDataFrame([(1, TABLE.replace("<td> N1 </td>", ""))], "id int, html string")
    with pytest.raises(Exception, match="do not fit"):
        h.html_table_rows(broken, "html", "id").collect()


PAGE = """<html><head><title>A &lt;b&gt;</title></head><body><div id="city"><ul class="x city_con"><li>北京</li><li class="q">上海</li></ul></div>
<a href="/p/1/">one</a><a class=z href='q2'>two</a><a href="http://h.com/p/1">x</a><a href="http://other.com/">y</a>
<img src="/i.png" alt="an image"><img alt='' src='j.png'/></body></html>"""


def test_html_selectors_and_links(spark):
    page = spark.createDataFrame([("http://h.com/start", PAGE)], "url string, html string")
    got = page.select(
        h.select(
            F.col("html"), title="title", li="li", by_class="ul.city_con", by_id="div#city", inside="div > ul.x li", none="body > li", second="li.q"
        ).alias("s")
    ).select(*[h.texts(F.col(f"s.{n}")).alias(n) for n in "title li by_class by_id inside none second".split()]).first()
    assert (got.title, got.li, got.by_class, got.by_id) == (["A <b>"], ["北京", "上海"], ["北京上海"], ["北京上海"])
    assert (got.inside, got.none, got.second) == (["北京", "上海"], [], ["上海"])
    links = {r.dst for r in h.html_links(page, "url", "html").collect()}
    assert links == {"http://h.com/p/1", "http://h.com/q2"}
    images = [(r.nth, r.src, r.alt) for r in h.html_images(page, "html").orderBy("nth").collect()]
    assert images == [(0, "/i.png", "an image"), (1, "j.png", "")]
    pager = one(spark, h.pager(F.lit("  共128条记录 当前页  2/13")))
    assert (pager.total, pager.page, pager.last) == (128, 2, 13)


GOLDEN = """<!doctype html><html><body><!-- <a href="/no">b --><div class="ad"><div>x</div>tail</div>
<p>one &#20013;&#x6587; &amp; <b>two</b><p>three<br>four<script>if (a < b) { "<p>no</p>" }</script>
<ul><li>a<ul><li>b</li></ul></li><li>c</ul><a href="http://a.com.evil/x">e</a><a href="/in?a=1&amp;b=2">f</a><a href="">g</a>
<table><tr><td>outer<table><tr><td>inner</td></tr></table></td><td>next</table><input disabled id=i></body></html>"""


def test_html_by_structure(spark):
    page = spark.createDataFrame([("http://a.com/p", GOLDEN), ("http://b.com", None), ("http://c.com", "<li>open <b>x")], "url string, html string")
    names = dict(ad="div.ad", p="p", li="li", top="body > ul > li", td="td", deep="td td", box="input[disabled]#i", gone="div.a")
    rows = page.select("url", h.select(F.col("html"), **names).alias("s")).collect()
    got = {r.url: {n: None if r.s[n] is None else [e.text for e in r.s[n]] for n in names} for r in rows}
    first = got["http://a.com/p"]
    assert first["ad"] == ["xtail"] and first["p"] == ["one 中文 & two", "three four"]
    assert first["li"] == ["ab", "b", "c"] and first["top"] == ["ab", "c"]
    assert first["td"] == ["outerinner", "inner", "next"] and first["deep"] == ["inner"]
    assert first["box"] == [""] and first["gone"] == []
    assert got["http://c.com"]["li"] == ["open x"] and set(got["http://b.com"].values()) == {None}
    assert next(r for r in rows if r.url == "http://a.com/p").s.ad[0].html == "<div>x</div>tail"
    assert [tuple(r) for r in h.html_links(page, "url", "html").collect()] == [("http://a.com/p", "http://a.com/in?a=1&b=2")]
    assert one(spark, h.inner_text(F.lit("a<!-- b > c -->&#20013;&#x6587;&#39;"))) == "a中文'"
    with pytest.raises(ValueError, match="selector"):
        h.select(F.col("html"), x="a ~ b")


def test_html_table_shapes(spark):
    """Quoted angle brackets, names in capitals, missing end tags, comments, and tables before the one with a head."""
    rows = "<TABLE><THEAD><TR><TD>A<TD>B</TR></THEAD><TBODY><TR data-key=k><TD>x<TD>y</TR></TBODY></TABLE>"
    pages = {
        '<table><thead><tr><td>A</td><td>B</td></tr></thead><tbody><tr><td title="a>b">x</td><td>y</td></tr></tbody></table>': (None, "x", "y"),
        rows: ("k", "x", "y"),
        f"<!-- <table><thead><tr><td>no</td></tr></thead></table> --><table><tr><td>z</td></tr></table>{rows}": ("k", "x", "y"),
        rows.replace("<TD>B", "<TD style='display: NONE'>H<TD>B").lower(): ("k", "x", "y"),
    }
    df = spark.createDataFrame(list(enumerate(pages)) + [(9, None), (10, ""), (11, "<table><tr><td>no head")], "id int, html string")
    got = {r.id: (r.row_key, r.cells["A"], r.cells["B"]) for r in h.html_table_rows(df.filter("id <> 3"), "html", "id").collect()}
    assert got == {i: w for i, w in enumerate(pages.values()) if i != 3}
    lower = h.html_table_rows(df.filter("id = 3"), "html", "id").first()
    assert (lower.row_key, lower.cells) == ("k", {"a": "x", "b": "y"})


def test_html_table_with_a_table_in_a_cell(spark):
    inner = "<table><thead><tr><td>q</td></tr></thead><tbody><tr><td>1</td></tr></tbody></table>"
    page = spark.createDataFrame([(1, TABLE.replace("<i>-</i>", inner))], "id int, html string")
    rows = h.html_table_rows(page, "html", "id").collect()
    assert len(rows) == 2 and {r.cells["开关"] for r in rows} == {'<span class="b switch-on"></span>', inner}


def test_link_frontier(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    out = link_frontier(links, spark.createDataFrame([("a",)], "node string"))
    assert sorted((r.node, r["round"]) for r in out.collect()) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_link_rounds_read_the_buckets_they_touch(spark, monkeypatch):
    """A short chain in a large graph: links of buckets that no round is in cannot be read."""
    import glob

    from ledgerspark.operators import links as ln

    chain = [(i, i + 1) for i in range(6)] + [(6, None), (None, 3)]
    others = spark.range(10**6, 10**6 + 20000).selectExpr("id AS src", "id + 1 AS dst")
    graph = spark.createDataFrame(chain, "src long, dst long").unionAll(others)
    near = {r.b for r in spark.range(7).select(F.pmod(F.xxhash64("id"), F.lit(64)).cast("int").alias("b")).collect()}
    write = ln.write_links

    def spoiled(*args):
        edges = write(*args)
        files = [f for f in glob.glob(f"{args[1]}/bucket=*/*.parquet") if int(f.split("bucket=")[1].split("/")[0]) not in near]
        for f in files:
            open(f, "wb").write(b"no parquet file")
        assert len(files) > 40
        return edges

    monkeypatch.setattr(ln, "write_links", spoiled)
    seeds = spark.createDataFrame([(0,), (0,), (None,)], "node long")
    out = ln.link_frontier(graph, seeds, buckets=64)
    assert sorted((r.node, r["round"]) for r in out.collect()) == [(i, i) for i in range(7)]
    assert ln.link_frontier(graph, seeds.filter("node > 5"), buckets=64).count() == 0


def test_greedy(spark):
    day = lambda n: dt.date(2020, 1, n)
    rows = [("k", day(s), day(e)) for s, e in ((1, 2), (2, 4), (1, 3))] + [("j", day(1), day(2))] * 3
    df = spark.createDataFrame(rows, "k string, s date, e date")
    assert {r.k: r.removed for r in greedy.interval_schedule(df, ["k"], "s", "e").collect()} == {"k": 1, "j": 2}


def most_kept(spans):
    """Over all choices of spans that do not end before they start."""
    import itertools

    def fits(chosen):
        ordered = sorted(chosen, key=lambda x: (x[1], x[0]))
        return all(b[0] >= a[1] for a, b in zip(ordered, ordered[1:]))

    spans = [x for x in spans if None not in x and x[0] <= x[1]]
    return max(len(c) for n in range(len(spans) + 1) for c in itertools.combinations(spans, n) if fits(c))


@pytest.mark.parametrize("chunks", [None, 6])
def test_interval_schedule_equals_brute_force(spark, chunks):
    """Empty spans, spans that end before they start, missing ends, and keys with nothing to keep; over one range and several."""
    import random

    rng = random.Random(5)
    rows = []
    for key in [*range(24), None]:
        for _ in range(rng.randint(1, 7)):
            s, e = rng.randint(1, 9), rng.randint(1, 9)
            rows.append((key, *((s, e) if rng.random() < 0.2 else sorted((s, e)))))
    rows += [(50, 5, 2), (51, None, 3), (51, 3, None), (52, 4, 4), (52, 4, 4)]
    want = {k: len(v) - most_kept(v) for k in {r[0] for r in rows} for v in [[r[1:] for r in rows if r[0] == k]]}
    df = spark.createDataFrame(rows, "k int, s int, e int")
    at = lambda c: F.timestamp_seconds(F.lit(1_700_000_000) + F.col(c) * 3600 * 7)
    forms = {
        "number": df,
        "date": df.select("k", F.date_add(F.lit("2020-02-25").cast("date"), F.col("s")).alias("s"), F.date_add(F.lit("2020-02-25").cast("date"), F.col("e")).alias("e")),
        "time": df.select("k", at("s").alias("s"), at("e").alias("e")),
        "local time": df.select("k", at("s").cast("timestamp_ntz").alias("s"), at("e").cast("timestamp_ntz").alias("e")),
    }
    for form in forms.values():
        assert {r.k: r.removed for r in greedy.interval_schedule(form, ["k"], "s", "e", chunks=chunks).collect()} == want
    with pytest.raises(TypeError):
        greedy.interval_schedule(df.withColumn("s", F.lit("x")), ["k"], "s", "e")


def test_one_hot_key_over_many_ranges(spark):
    import random

    rng = random.Random(6)
    spans = [(s, s + rng.choice((0, 1, 3, 50))) for s in (rng.randrange(20000) for _ in range(6000))]
    kept, last = 0, -1
    for s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if s >= last:
            kept, last = kept + 1, e
    df = spark.createDataFrame(spans, "s int, e int")
    for chunks in (1, 13):
        assert greedy.interval_schedule(df, [], "s", "e", chunks=chunks).first().removed == len(spans) - kept


def test_keys_with_few_ends_are_gone_through_in_order(spark, monkeypatch):
    """Running values and steps take the keys with many ends only; both ways give the same."""
    import random

    rng = random.Random(8)
    rows = [(k, s, s + rng.randint(-1, 6)) for k in (None, 1, 2, 3) for s in (rng.randrange(60) for _ in range(80 if k in (None, 2) else 9))]
    rows += [(4, 5, 2), (4, None, 3), (4, 3, None)]
    df = spark.createDataFrame(rows, "k int, s int, e int")
    taken, running = [], greedy.with_running

    def seen(df, *args, **kw):
        taken.append({r.k for r in df.select("k").distinct().collect()})
        return running(df, *args, **kw)

    monkeypatch.setattr(greedy, "with_running", seen)
    out = {few: {r.k: r.removed for r in greedy.interval_schedule(df, ["k"], "s", "e", few=few).collect()} for few in (20, 1000, 0)}
    assert taken == [{None, 2}, {None, 1, 2, 3}]
    assert out[20] == out[1000] == out[0] and out[0][4] == 3


def test_greedy_assignment_equals_matching(spark):
    import random

    rng = random.Random(3)
    needs = [(rng.choice("ab"), rng.randint(1, 9)) for _ in range(60)]
    sizes = [(rng.choice("ab"), rng.randint(1, 9)) for _ in range(50)]
    want = {}
    for key in "ab":
        left, met = sorted(v for k, v in sizes if k == key), 0
        for need in sorted(v for k, v in needs if k == key):
            fit = next((i for i, v in enumerate(left) if v >= need), None)
            if fit is not None:
                left.pop(fit)
                met += 1
        want[key] = met
    for limit in (1, 9):
        out = greedy.greedy_assignment(
            spark.createDataFrame(needs, "k string, need int"), spark.createDataFrame(sizes, "k string, size int"),
            ["k"], "need", "size", chunks=limit,
        )
        assert {r.k: r.met for r in out.collect()} == want


def test_forms(spark):
    answers = [
        {"queId": 1, "queTitle": "name", "queType": 2, "values": [{"value": 'a "b"\n\\é'}]},
        {"queId": 2, "queTitle": "n", "queType": 8, "values": [{"value": "007"}]},
        {"queId": 3, "queTitle": "d", "queType": 8, "values": [{"value": "1.50"}]},
        {"queId": 4, "queTitle": "e", "queType": 8, "values": [{"value": ""}]},
        {"queId": 5, "queTitle": "t", "queType": 8, "values": [{"value": "x1"}]},
        {"queId": 6, "queTitle": "many", "queType": 12, "values": [{"value": "p"}, {"value": "q"}]},
        {"queId": 7, "queTitle": "who", "queType": 5, "values": [{"id": 4, "value": "N", "email": "e@x", "otherInfo": None}]},
        {"queId": 8, "queTitle": "dept", "queType": 22, "values": [{"id": 9, "value": "D"}]},
        {"queId": 9, "queTitle": "span", "queType": 14, "values": [{"value": "2020-01-01~2020-02-01"}]},
        {"queId": 10, "queTitle": "rows", "queType": 18, "tableValues": [[{"queId": 11, "queTitle": "c", "queType": 2, "values": [{"value": "v"}]}]]},
    ]
    out = json.loads(one(spark, forms.form_answer_to_value(F.col("a")), a=json.dumps(answers)))
    assert out == {
        "name": 'a "b"\n\\é', "n": 7, "d": 1.5, "e": None, "t": "x1", "many": ["p", "q"],
        "who": [{"uid": 4, "name": "N", "email": "e@x", "head": None}], "dept": [{"id": 9, "name": "D"}],
        "span": ["2020-01-01", "2020-02-01"], "rows": [{"c": "v"}],
    }
    with pytest.raises(Exception, match="type 99"):
        one(spark, forms.form_answer_to_value(F.col("a")), a=json.dumps([{"queTitle": "x", "queType": 99, "values": []}]))
    titled = json.dumps([
        {"queTitle": "编号", "values": [{"value": "20"}]}, {"queTitle": "数字1", "values": [{"value": 20}]},
        {"queTitle": "数字2", "queType": "8", "values": [{"value": 20}]}, {"queId": 0, "queTitle": "own", "values": [{"value": "1"}]},
    ])
    get = lambda t, k: one(spark, forms.answer_get_by_title(forms.parse_answers(F.col("a")), t, k), a=titled)
    assert (get("编号", "string"), get("数字1", "long"), get("数字2", "long")) == ("20", 20, 20)
    with pytest.raises(Exception, match="no answer titled own"):
        get("own", "string")


def test_form_rows(spark):
    df = spark.createDataFrame([(1, "x", None, "Ann"), (2, None, 5, "Bob")], "k int, a string, b int, who string")
    members = spark.createDataFrame([("Ann", 11)], "name string, id int")
    form = [(0, "k", 8), (1, "a", 2), (2, "b", 8), (3, "who", 5)]
    out = {r.k: json.loads(r.answers) for r in forms.form_row_to_answers(df, form, ["k"], members).collect()}
    assert out == {
        1: [{"queId": 1, "values": [{"value": "x"}]}, {"queId": 3, "values": [{"id": 11, "value": "Ann"}]}],
        2: [{"queId": 2, "values": [{"value": "5"}]}],
    }
    with pytest.raises(ValueError):
        forms.form_row_to_answers(df, [(4, "a", 18)], ["k"])


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    cases = {"none": [], "some": [(1,), (1,)], "null": [(1,), (None,)]}
    for name, values in cases.items():
        right = spark.createDataFrame(values, "v int")
        want = spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT v FROM {r})", l=left, r=right)
        assert sorted(map(str, rel.not_in(left, "k", right, "v").collect())) == sorted(map(str, want.collect())), name


def test_sql_exercises(spark):
    scores = spark.createDataFrame([(1, 350), (2, 365), (3, 400), (4, 385), (5, 400), (6, 365)], "id int, score int")
    assert sorted((r.score, r.rank) for r in win.dense_rank_desc(scores, "score").collect()) == [
        (350, 4), (365, 3), (365, 3), (385, 2), (400, 1), (400, 1),
    ]
    logs = spark.createDataFrame([(i, v) for i, v in enumerate([1, 1, 1, 2, 1, 2, 2])], "id int, num int")
    for limit in (1, 4):
        assert [r.num for r in win.consecutive_values(logs, [], "id", "num", 3, chunks=limit).collect()] == [1]
    days = [("U01", d) for d in (10, 11, 12, 14, 15, 17, 18, 19, 20)] + [("U02", 20)]
    logins = spark.createDataFrame([(u, dt.date(2019, 10, d)) for u, d in days], "u string, d date")
    assert {r.u: r.streak for r in win.longest_streak(logins, "u", "d").collect()} == {"U01": 4, "U02": 1}
    prices = spark.createDataFrame([("k", i, p) for i, p in enumerate([7, 1, 5, 3, 6, 4])], "k string, d int, p int")
    assert agg.price_rises(prices, ["k"], "d", "p").first().profit == 7
    seats = spark.createDataFrame(list(enumerate(["Abbot", "Doris", "Emerson", "Green", "Jeames"], 1)), "id int, student string")
    assert [r.student for r in rel.swap_adjacent(seats, "id").orderBy("id").collect()] == ["Doris", "Abbot", "Green", "Emerson", "Jeames"]
    pay = spark.createDataFrame([("d", v) for v in (1, 1, 5, 7, 9, 9)], "dept string, v int")
    assert agg.average_without_extremes(pay, "dept", "v").first().average == 6.0
    assert rel.second_highest(spark.createDataFrame([(100,), (100,)], "s int"), "s").first()[0] is None
    merged = spark.createDataFrame([("k", 1, ("a1", 1)), ("k", 2, ("a2", None)), ("k", 3, (None, 2))], "k string, id int, a struct<s:string,n:int>")
    out = [(r.a.s, r.a.n) for r in win.merge_last_non_null(merged, "a", ["k"], ["id"]).orderBy("id").collect()]
    assert out == [("a1", 1), ("a2", 1), ("a2", 2)]
    flow = spark.createDataFrame([("1\t137\tmac\tip\t10\t20\t200",), ("2\t137\tmac\tip\thost\t1\t2\t200",)], "value string")
    assert tuple(agg.flow_sum(flow).first()) == ("137", 11, 22, 33)


def test_string_join_parts(spark):
    df = spark.createDataFrame([("k", i, None if i % 4 == 0 else str(i)) for i in range(30)], "k string, o int, v string")
    parts = agg.string_join(df, ["k"], ["o"], "v", per_row=7, chunks=5).orderBy("part").collect()
    assert ",".join(r.joined for r in parts) == ",".join(str(i) for i in range(30) if i % 4)


def test_lists_only_from_small_domains(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"))
    assert agg.groups_without(df, "k", F.lit(False), "v", most=50).count() == 3
    with pytest.raises(Exception, match="more than 49 values"):
        agg.groups_without(df, "k", F.lit(False), "v", most=49).collect()


def test_pages_of_one_row_group_are_parsed_in_several_tasks(spark):
    for name in ("html_switch_flags", "html_table_rows"):
        rows = entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_pages_become_arrow_a_few_at_a_time():
    class Row(dict):
        __hash__ = object.__hash__

    alive, most = weakref.WeakSet(), 0

    def read(page):
        nonlocal most
        row = Row(a=page)
        alive.add(row)
        most = max(most, len(alive))
        return row

    pages = pa.array([None, *map(str, range(5 * h.PART))])
    assert h._in_parts(pages, read, pa.struct({"a": pa.string()})).field("a").to_pylist() == pages.to_pylist()
    assert most <= 2 * h.PART
    assert len(h._in_parts(pages[:0], read, pa.struct({"a": pa.string()}))) == 0
