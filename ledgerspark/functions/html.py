"""What the crawlers take from pages, as expressions over the page text."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.page_tree import Element, Tree, compiled, find

# The pager line, the unit suffix of table heads, and the host part of a link.
PAGER = r"^\s*共(\d+)条记录\s*当前页\s*(\d+)/(\d+)"
UNIT_SUFFIX = r"\(元\)$"
HOST = r"^((?:https?://)?[^/\s]*)"

ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

ELEMENT = "struct<html: string, text: string, attributes: map<string,string>>"
#: Pages whose elements are Python objects at a time, which bounds the memory of a batch.
PART = 128

_STRING = pa.string()
_ELEMENT = pa.struct({"html": _STRING, "text": _STRING, "attributes": pa.map_(_STRING, _STRING)})
_TABLE = pa.struct({"heads": pa.list_(_STRING), "rows": pa.list_(pa.struct({"row_key": _STRING, "cells": pa.list_(_STRING)}))})
TABLE = "struct<heads: array<string>, rows: array<struct<row_key: string, cells: array<string>>>>"


def _numeric(text: Column) -> Column:
    """Numeric character references, decimal and hexadecimal, as characters."""
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)&#(x[0-9a-f]{1,6}|[0-9]{1,7});"), F.lit(1)))

    def put(done: Column, code: Column) -> Column:
        number = F.when(F.lower(F.left(code, F.lit(1))) == "x", F.conv(F.substr(code, F.lit(2)), 16, 16)).otherwise(F.conv(code, 10, 16))
        char = F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32")
        return F.replace(done, F.concat(F.lit("&#"), code, F.lit(";")), char)

    return F.when(text.contains("&#"), F.aggregate(codes, text, put)).otherwise(text)


def unescape(text: Column) -> Column:
    text = _numeric(text)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def inner_text(html: Column) -> Column:
    """Text of a fragment: comments and tags dropped, entities resolved, white space collapsed."""
    seen = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    plain = F.regexp_replace(F.regexp_replace(seen, r"(?i)<br\s*/?>", " "), r"(?s)<[^>]*>", "")
    return F.trim(F.regexp_replace(unescape(plain), r"\s+", " "))


def select(html: Column, **selectors: str) -> Column:
    """Struct with, for each name, the elements that a selector finds, in page order.

    Selectors combine tag, ``#id``, ``.class`` and ``[attribute=value]``, with a space for a descendant
    and ``>`` for a child. Nested elements, comments, scripts and missing end tags are told apart by
    structure. A page is parsed once, however many selectors there are; a null page has none.
    """
    steps = {name: compiled(s) for name, s in selectors.items()}

    kind = pa.struct({name: pa.list_(_ELEMENT) for name in selectors})

    def read(page: str | None) -> dict:
        tree = Tree(page) if page is not None else None
        return {name: [_shown(page, e) for e in find(tree, s)] if tree else None for name, s in steps.items()}

    @F.arrow_udf(", ".join(f"{name} array<{ELEMENT}>" for name in selectors))
    def run(pages: pa.Array) -> pa.Array:
        return _in_parts(pages, read, kind)

    return run(html)


def attribute_values(html: Column, selector: str, name: str) -> Column:
    """The attribute ``name`` of each element that a selector finds, in page order; nothing else of a page is kept."""
    steps = compiled(selector)

    def read(page: str | None) -> list | None:
        return [e.attributes.get(name) for e in find(Tree(page), steps)] if page is not None else None

    @F.arrow_udf("array<string>")
    def run(pages: pa.Array) -> pa.Array:
        return _in_parts(pages, read, pa.list_(_STRING))

    return run(html)


def _in_parts(pages: pa.Array, read: Callable[[str | None], object], kind: pa.DataType) -> pa.Array:
    """``read`` of every page, turned into Arrow a few pages at a time."""
    parts = [pages.slice(at, PART) for at in range(0, len(pages), PART)] or [pages]
    return pa.concat_arrays([pa.array([read(p.as_py()) for p in part], kind) for part in parts])


def _shown(page: str, e: Element) -> dict:
    return {"html": page[e.start : e.stop], "text": e.text(), "attributes": list(e.attributes.items())}


def texts(elements: Column) -> Column:
    return F.transform(elements, lambda e: e["text"])


def switch_flag(cell: Column) -> Column:
    """State of an on/off switch in a table cell; null when there is no switch."""
    return F.when(cell.rlike(r"""(?is)<span\s[^>]*\bswitch-on\b"""), True).when(
        cell.rlike(r"""(?is)<span\s[^>]*\bswitch-off\b"""), False
    )


def _hidden(e: Element) -> bool:
    return "display:none" in e.attributes.get("style", "").replace(" ", "").lower()


def _table(page: str | None) -> dict:
    tree = Tree(page) if page is not None else None
    table = next((e for e in tree.elements if e.tag == "table" and e.children("thead")), None) if tree else None
    if table is None:
        return {"heads": None, "rows": None}
    first = next(iter(table.children("thead")[0].children("tr")), None)
    heads = [e.text() for e in first.children("td", "th") if not _hidden(e)] if first else []
    found = [r for body in table.children("tbody")[:1] for r in body.children("tr")]
    rows = [{"row_key": r.attributes.get("data-key"), "cells": [page[c.start : c.stop] for c in r.children("td")]} for r in found]
    return {"heads": heads, "rows": rows}


def _tables(pages: pa.Array) -> pa.Array:
    return _in_parts(pages, _table, _TABLE)


def html_table_rows(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """One row per body row of a page's first table with a head: its ``data-key`` and a map from head to
    cell HTML.

    Hidden head cells are no columns, and the unit suffix of a head is dropped. A row whose cell
    count is not that of the head is an error. Tables within cells are part of the cell.

    All pages are read by structure, in one way: names in any case, quoted attributes, comments and missing end tags.
    """
    read = pages.select(*keep, F.arrow_udf(_tables, TABLE)(F.col(html)).alias("_t"))
    names = F.transform("_t.heads", lambda t: F.regexp_replace(t, UNIT_SUFFIX, ""))
    rows = read.select(*keep, names.alias("_names"), F.explode("_t.rows").alias("_row"))
    checked = F.when(F.size("_row.cells") == F.size("_names"), F.map_from_arrays("_names", "_row.cells")).otherwise(
        F.raise_error(F.concat(F.lit("cells do not fit the head: "), F.to_json("_row"))).cast("map<string,string>")
    )
    return rows.select(*keep, F.col("_row.row_key").alias("row_key"), checked.alias("cells"))


def pager(text: Column) -> Column:
    """Numbers of a pager line as ``{total, page, last}``."""
    return F.struct(
        *[F.regexp_extract(text, PAGER, i + 1).try_cast("int").alias(n) for i, n in enumerate(("total", "page", "last"))]
    )


def host(url: Column) -> Column:
    return F.regexp_extract(url, HOST, 1)


def html_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Distinct links (src, dst) of pages to their own host; relative ones are made absolute and a
    trailing slash is dropped. Links within comments do not count."""
    hrefs = F.explode(attribute_values(F.col(html), "a[href]", "href"))
    found = pages.select(F.col(url).alias("src"), host(F.col(url)).alias("_host"), hrefs.alias("_href"))
    to = F.trim("_href")
    absolute = (
        F.when(to.startswith("http"), to)
        .when(to.startswith("/"), F.concat("_host", to))
        .otherwise(F.concat(F.col("_host"), F.lit("/"), to))
    )
    links = found.filter(to != "").select("src", "_host", F.regexp_replace(absolute, "/$", "").alias("dst"))
    return links.filter(host(F.col("dst")) == F.col("_host")).select("src", "dst").distinct()


def html_images(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """Source and alternative text of each image of a page, in page order."""
    tags = pages.select(*keep, F.posexplode(select(F.col(html), img="img")["img"]).alias("nth", "_img"))
    return tags.select(*keep, "nth", *[F.col("_img.attributes")[c].alias(c) for c in ("src", "alt")])
