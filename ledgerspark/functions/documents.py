"""JSON documents and JSON patches.

Sub-documents are carried as the text they were read from, so key order and number kind stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    return F.to_json(text.cast("variant"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def json_fields(document: Column) -> Column:
    """Fields of a JSON object in their order: array of (key, raw), raw being the value's JSON text."""

    def field(text: Column, value: Column) -> Column:
        raw = F.when(F.is_variant_null(value), "null").when(F.schema_of_variant(value) == "STRING", F.to_json(value)).otherwise(text["value"])
        return F.struct(text["key"].alias("key"), raw.alias("raw"))

    texts, kinds = F.from_json(document, "map<string,string>"), F.from_json(document, "map<string,variant>")
    return F.zip_with(F.map_entries(texts), F.map_values(kinds), field)


def json_object(fields: Column) -> Column:
    """JSON text of an array of (key, raw)."""
    return F.concat(F.lit("{"), F.array_join(F.transform(fields, lambda f: F.concat(quoted(f["key"]), F.lit(":"), f["raw"])), ","), F.lit("}"))


def json_to_patch(document: Column) -> Column:
    """JSON object to ``[{op: replace, path: /key, value}]``, one entry per top-level field."""
    entries = F.transform(
        json_fields(document),
        lambda f: F.concat(F.lit('{"op":"replace","path":'), quoted(F.concat(F.lit("/"), f["key"])), F.lit(',"value":'), f["raw"], F.lit("}")),
    )
    return F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]"))


def json_set_field(a: Column, b: Column, path: str) -> Column:
    """Object ``a`` with its top-level field at ``path`` set to document ``b``; ``a`` when either is null.

    A ``b`` that is no JSON is an error.
    """
    key = path.removeprefix("/")
    raw = F.when(F.parse_json(b).isNotNull(), F.trim(b))

    def put(fields: Column) -> Column:
        replaced = F.transform(fields, lambda f: F.struct(f["key"].alias("key"), F.when(f["key"] == key, raw).otherwise(f["raw"]).alias("raw")))
        added = F.concat(fields, F.array(F.struct(F.lit(key).alias("key"), raw.alias("raw"))))
        return json_object(F.when(F.exists(fields, lambda f: f["key"] == key), replaced).otherwise(added))

    return F.when(a.isNull() | b.isNull(), a).otherwise(bound(json_fields(a), put))


def patch_entry(op: str, path: str, value: Column | None = None) -> Column:
    """One patch entry as JSON text; an entry that removes has no value."""
    fields = [F.lit(op).alias("op"), F.lit(path).alias("path")]
    if value is not None and op != "remove":
        fields.append(value.alias("value"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def build_patch(*entries: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *entries), F.lit("]"))


def _is_object(raw: Column) -> Column:
    return raw.startswith("{")


def _prune(raw: Column, paths: list[tuple[str, ...]]) -> Column:
    """The parts of a value that ``paths`` name; a path that ends here keeps all, unless a longer
    one narrows it. Null when nothing is left. The paths are literals, so the depth is theirs."""
    deeper = [p for p in paths if p]
    if not deeper:
        return raw
    below: dict[str, list[tuple[str, ...]]] = {}
    for p in deeper:
        below.setdefault(p[0], []).append(p[1:])

    def part(f: Column) -> Column:
        name = F.replace(F.replace(f["key"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        kept = [F.when(name == segment, _prune(f["raw"], rest)) for segment, rest in below.items()]
        return F.struct(f["key"].alias("key"), F.coalesce(*kept).alias("raw"))

    kept = F.filter(F.transform(json_fields(raw), part), lambda f: f["raw"].isNotNull())
    whole = raw if any(not p for p in paths) else F.lit(None).cast("string")
    return F.when(~_is_object(raw), whole).otherwise(bound(kept, lambda k: F.when(F.size(k) > 0, json_object(k))))


def patch_filter(patch: Column, *retain: str) -> Column:
    """Patch entries that touch the retained paths, their object values pruned to those paths.

    An entry at or below a retained path stays. One above a retained path stays if it removes, or
    with what its object holds of the path. Paths are JSON pointers, ``~0`` and ``~1`` included.
    """
    retained = [tuple(p.split("/")[1:]) for p in retain]
    inner: dict[str, list[tuple[str, ...]]] = {}
    for r in retained:
        for n in range(len(r) + 1):
            inner.setdefault("".join(f"/{s}" for s in r[:n]), []).append(r[n:])

    at = ["".join(f"/{s}" for s in r) for r in retained]

    def parts(fields: Column) -> Column:
        def of(key: str) -> Column:
            return F.get(F.filter(fields, lambda f: f["key"] == key), 0)["raw"]

        op, path = (F.coalesce(F.parse_json(of(k)).cast("string"), F.lit("")).alias(k) for k in ("op", "path"))
        return F.struct(op, path, of("value").alias("value"), fields.alias("fields"))

    def kept(entry: Column, e: Column) -> Column:
        op, path, value = e["op"], e["path"], e["value"]
        above = reduce(lambda a, b: a | b, [(path == t) | path.startswith(f"{t}/") for t in at], F.lit(False))
        known = path.isin(*inner)
        pruned = reduce(lambda rest, p: F.when(path == p, _prune(value, inner[p])).otherwise(rest), inner, F.lit(None).cast("string"))

        def narrowed(raw: Column) -> Column:
            put = F.transform(e["fields"], lambda f: F.struct(f["key"].alias("key"), F.when(f["key"] == "value", raw).otherwise(f["raw"]).alias("raw")))
            return F.when(raw.isNotNull() & (raw != "{}"), json_object(put))

        return (
            F.when(op == "remove", F.when(above | known, entry))
            .when(~op.isin("add", "replace"), F.raise_error(F.concat(F.lit("patch operation is not supported: "), op)).cast("string"))
            .when(F.coalesce(_is_object(value), F.lit(False)) & known, bound(pruned, narrowed))
            .otherwise(F.when(above, entry))
        )

    def judged(entry: Column) -> Column:
        return bound(bound(json_fields(entry), parts), lambda e: kept(entry, e))

    entries = F.filter(F.transform(F.from_json(patch, "array<string>"), judged), lambda e: e.isNotNull())
    return F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]"))
