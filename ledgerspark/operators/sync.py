"""Comparing a source with the copy kept of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.keys import one_per_key

INT_MAX = 2147483647


def compare_by_key(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Full join of both sides by key: key, source, target (structs of the source's columns) and
    change, one of insert, update, delete, unchanged. A null key is a key like any other."""
    columns = [c for c in source.columns if c != key]
    missing = [c for c in columns if c not in target.columns]
    wide = target.select("*", *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in missing])
    s, t = one_per_key(source, [key], columns, "source"), one_per_key(wide, [key], columns, "target")
    s, t = s.withColumn("_in_source", F.lit(True)), t.withColumn("_in_target", F.lit(True))
    source_key, target_key = F.col(f"source_{key}"), F.col(f"target_{key}")
    change = (
        F.when(F.col("_in_target").isNull(), "insert")
        .when(F.col("_in_source").isNull(), "delete")
        .when(~F.col("source").eqNullSafe(F.col("target")), "update")
        .otherwise("unchanged")
    )
    return s.join(t, source_key.eqNullSafe(target_key), "full").select(
        F.coalesce(source_key, target_key).alias(key), "source", "target", change.alias("change")
    )


def sync_by_key(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Changes that make the target equal the source in the source's columns.

    Columns that only the target has are left alone; a null text key counts as empty text.
    """
    if dict(source.dtypes)[key] == "string":
        source = source.withColumn(key, F.coalesce(key, F.lit("")))
        target = target.withColumn(key, F.coalesce(key, F.lit("")))
    return compare_by_key(source, target, key).filter("change <> 'unchanged'")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def apply_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The target after the changes; its own extra columns stay, and are null in new rows."""
    columns = changes.schema["source"].dataType.names
    extra = [c for c in target.columns if c != key and c not in columns]
    c = changes.select(F.col(key).alias("_key"), "source", "change")
    joined = target.join(c, F.col(key).eqNullSafe(F.col("_key")), "full").filter("change IS NULL OR change <> 'delete'")
    return joined.select(
        F.coalesce(key, "_key").alias(key),
        *[F.when(F.col("change").isNull(), F.col(n)).otherwise(F.col(f"source.{n}")).alias(n)
          for n in columns if n in target.columns],
        *extra,
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new snapshot in full (flag 0) and what changed since the old one (flag 1).

    A deleted row keeps its key, with its other columns null.
    """
    columns = [c for c in new.columns if c != key]
    compared = compare_by_key(new, old, key)
    flags = F.when(F.col("change") == "unchanged", F.array(F.lit(0))).when(
        F.col("change") == "delete", F.array(F.lit(1))
    ).otherwise(F.array(F.lit(0), F.lit(1)))
    rows = compared.select(key, "source", "change", F.explode(flags).alias("flag"))
    return rows.select(
        key, *[F.col(f"source.{c}").alias(c) for c in columns], "flag",
        F.when(F.col("flag") == 1, F.col("change")).alias("change_type"),
    )


def missing_keys(current: DataFrame, models: DataFrame, key: str) -> DataFrame:
    """Keys of ``current`` for which ``models`` has no row."""
    return current.select(key).distinct().join(models.select(key), key, "left_anti")


def enrich(current: DataFrame, models: DataFrame, filled: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``current`` with the model of each key: the known ones and those filled in for missing keys. With ``parts``, that many
    tasks join them, whatever a shuffle has."""
    known = models.unionByName(filled)
    return current.join(known.repartition(parts, key) if parts else known, key, "left")


def count_guard(local: DataFrame, online: DataFrame, app: str, entity: str) -> DataFrame:
    """Per app: entities kept, newly seen and online; ``ok`` when kept + new covers online."""
    both = local.select(app, entity, F.lit(1).alias("l"), F.lit(0).alias("o")).unionAll(
        online.select(app, entity, F.lit(0), F.lit(1))
    )
    seen = both.groupBy(app, entity).agg(F.max("l").alias("l"), F.max("o").alias("o"))
    counts = seen.groupBy(app).agg(
        F.sum("l").alias("kept"), F.sum(F.when(F.col("l") == 0, 1).otherwise(0)).alias("added"), F.sum("o").alias("online")
    )
    return counts.withColumn("ok", F.col("kept") + F.col("added") >= F.col("online"))


def tombstones(local: DataFrame, online: DataFrame, app: str, entity: str, now: Column) -> DataFrame:
    """A closing row for each (app, entity) that is kept but gone online."""
    gone = local.select(app, entity).distinct().join(online.select(app, entity), [app, entity], "left_anti")
    return gone.select(
        app, entity, F.lit(INT_MAX).alias("log_id"), F.lit("删除").alias("audit_name"), F.lit(-1).alias("audit_result"),
        now.alias("audit_time"), F.lit(None).cast("string").alias("after"),
    )


def high_water_bounds(
    fetched: DataFrame, kept: DataFrame, app: str, update_time: str, audit_time: str, first_seen: DataFrame
) -> DataFrame:
    """Fetched rows no older than the newest kept update of their app and audited no later than
    the newest time seen when fetching began (``first_seen``: app, newest)."""
    low = kept.groupBy(app).agg(F.max(update_time).alias("_low"))
    bounds = first_seen.join(low, app, "full")
    return (
        fetched.join(bounds, app, "left")
        .filter(
            (F.col("_low").isNull() | (F.col(update_time) >= F.col("_low")))
            & (F.col("newest").isNull() | (F.col(audit_time) <= F.col("newest")))
        )
        .select(*fetched.columns)
    )
