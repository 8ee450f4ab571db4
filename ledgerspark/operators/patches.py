"""JSON patches filtered by a table of retained paths.

Patch entries and the fields of their objects become rows with their path, retained paths a table of all their
beginnings, and the two meet by equality. Objects are opened only along beginnings of retained paths, level
by level, and put together again from what was kept. The plan grows with the depth of the longest retained
path, and not with how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.documents import bound, json_fields, json_object
from ledgerspark.session import stored


def _beginnings(path: Column) -> Column:
    """All beginnings of a JSON pointer, the empty one and itself included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def retained_table(retained: DataFrame, path: str = "path") -> DataFrame:
    """Beginnings of the retained paths: _at, _end (a retained path ends here), _deeper (one goes on)."""
    paths = retained.filter(F.col(path).isNotNull()).select(F.col(path).alias("_path")).distinct()
    each = paths.select("_path", F.explode(_beginnings(F.col("_path"))).alias("_at"))
    return each.groupBy("_at").agg(F.bool_or(F.col("_at") == F.col("_path")).alias("_end"), F.bool_or(F.col("_at") != F.col("_path")).alias("_deeper"))


def _is_object(raw: Column) -> Column:
    return F.coalesce(raw.startswith("{"), F.lit(False))


def filter_patches(docs: DataFrame, keys: Sequence[str], patch: str, retained: DataFrame, path: str = "path") -> DataFrame:
    """keys and ``kept``, the patch of each row with the entries that touch a retained path, their object values pruned to
    those paths.

    An entry at or below a retained path stays. One above a retained path stays if it removes, or with what
    its object holds of the path; a path that ends at an object keeps all of it, unless a longer one
    narrows it. Paths are JSON pointers, ``~0`` and ``~1`` included. ``keys`` name one row each, null among
    them; a null patch stays null. Operations other than add, replace and remove are an error.
    """
    keys = list(keys)
    at = [*keys, "_pos"]
    table = retained_table(retained, path)
    depth = table.agg(F.max(F.size(F.split("_at", "/")))).first()[0] or 0  # levels, one more than segments

    def part(fields: str, name: str) -> Column:
        return F.get(F.filter(fields, lambda f: f["key"] == name), 0)["raw"]

    entries = docs.select(*keys, F.posexplode(F.from_json(patch, "array<string>")).alias("_pos", "_entry"))
    entries = entries.withColumn("_fields", json_fields(F.col("_entry")))
    entries = entries.select(
        *at, "_entry", "_fields", part("_fields", "value").alias("_value"),
        *[F.coalesce(F.parse_json(part("_fields", n)).cast("string"), F.lit("")).alias(f"_{n}") for n in ("op", "path")],
    )
    # a row for each beginning of an entry's path: retained ones make it stay, its own says where to open its object
    asked = entries.select("*", F.explode(_beginnings(F.col("_path"))).alias("_at")).join(table, "_at", "left")
    own = F.when(F.col("_at") == F.col("_path"), F.col("_deeper"))
    judged = asked.groupBy(*at).agg(
        *[F.any_value(c).alias(c) for c in ("_entry", "_fields", "_value", "_op", "_path")],
        F.coalesce(F.bool_or("_end"), F.lit(False)).alias("_above"), F.max(own).alias("_open"),
        F.coalesce(F.bool_or(F.when(F.col("_at") == F.col("_path"), F.col("_end"))), F.lit(False)).alias("_ends"),
    )
    known, is_object = F.col("_open").isNotNull(), _is_object(F.col("_value"))
    refused = F.raise_error(F.concat(F.lit("patch operation is not supported: "), "_op")).cast("boolean")
    pruned = F.when(F.col("_op") == "remove", F.lit(False)).when(~F.col("_op").isin("add", "replace"), refused).otherwise(known & is_object)
    # read twice below, and the JSON of an entry is read for it
    judged = stored(judged.withColumn("_pruned", pruned), "judged")

    none = F.array().cast("array<string>")
    opened = judged.filter("_pruned").select(
        *at, F.array().cast("array<int>").alias("_trail"), none.alias("_names"), F.col("_path").alias("_at"), F.col("_value").alias("_raw"),
        F.col("_open").alias("_deeper"), F.col("_ends").alias("_end"),
    )
    node = [*at, "_trail", "_names", "_raw"]
    kept = opened.filter("NOT _deeper").select(*node)
    for _ in range(1, depth):
        fields = opened.filter(F.col("_deeper") & _is_object(F.col("_raw"))).select(*at, "_trail", "_names", "_at", F.posexplode(json_fields(F.col("_raw"))).alias("_i", "_f"))
        name = F.replace(F.replace(F.col("_f.key"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        opened = fields.select(
            *at, F.array_append("_trail", F.col("_i")).alias("_trail"), F.array_append("_names", F.col("_f.key")).alias("_names"),
            F.concat("_at", F.lit("/"), name).alias("_at"), F.col("_f.raw").alias("_raw"),
        ).join(table, "_at")
        leaf = ~F.col("_deeper") | (F.col("_end") & ~_is_object(F.col("_raw")))
        kept = kept.unionByName(opened.filter(leaf).select(*node))
    for size in range(depth - 1, 0, -1):
        inner = kept.filter(F.size("_trail") == size)
        above = [F.slice(c, 1, size - 1).alias(c) for c in ("_trail", "_names")]
        field = F.struct(F.get("_trail", F.lit(size - 1)).alias("i"), F.get("_names", F.lit(size - 1)).alias("key"), F.col("_raw").alias("raw"))
        whole = inner.groupBy(*at, *above).agg(F.sort_array(F.collect_list(field)).alias("_list"))
        kept = kept.filter(F.size("_trail") < size).unionByName(whole.select(*at, "_trail", "_names", json_object(F.col("_list")).alias("_raw")))

    found = kept.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(at)], F.col("_raw").alias("_new"))
    same = reduce(lambda a, b: a & b, [judged[c].eqNullSafe(found[f"_k{i}"]) for i, c in enumerate(at)])
    put = lambda fields: json_object(F.transform(fields, lambda f: F.struct(f["key"].alias("key"), F.when(f["key"] == "value", F.col("_new")).otherwise(f["raw"]).alias("raw"))))
    narrowed = F.when(F.col("_new").isNotNull() & (F.col("_new") != "{}"), bound(F.col("_fields"), put))
    shown = F.when(F.col("_pruned"), narrowed).when(F.col("_above") | (F.col("_op") == "remove") & known, F.col("_entry"))
    text = judged.join(found, same, "left").select(*at, shown.alias("_text")).filter("_text IS NOT NULL")
    lists = text.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(F.struct("_pos", "_text")))["_text"], ",").alias("_all"))
    lists = lists.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_all")
    mine = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    out = F.when(F.col(patch).isNotNull(), F.concat(F.lit("["), F.coalesce("_all", F.lit("")), F.lit("]")))
    return docs.select(*keys, patch).join(lists, mine, "left").select(*keys, out.alias("kept"))
