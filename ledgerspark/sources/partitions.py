"""Partitioned tables that are brought up to date partition by partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.session import stored

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def data_files(spark: SparkSession, path: str, parts: str | T.StructType = "", glob: str = "*.parquet") -> DataFrame:
    """One row per data file: path, modificationTime and the partition columns of the schema ``parts``.

    The files are listed, not opened. With ``parts`` the directories are discovered as partitions, so a
    condition on those columns leaves the other directories out; without, any layout is listed.
    """
    schema = T.StructType.fromDDL(parts) if isinstance(parts, str) else parts
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if len(schema):
        files = reader.schema(T.StructType([*T.StructType.fromDDL(FILE_SCHEMA).fields, *schema.fields])).load(path)
    else:
        files = reader.option("recursiveFileLookup", True).load(path)
    return files.select("path", "modificationTime", *schema.names)


def partition_file_stats(spark: SparkSession, path: str, parts: str, lo=None, hi=None) -> DataFrame:
    """Per partition: first and last modification time of its files changed in [lo, hi).

    ``parts`` is the schema of the partition columns, as DDL.
    """
    time = F.col("modificationTime")
    lo = F.coalesce(F.lit(lo), F.lit("2000-01-01")).cast("timestamp")
    hi = F.coalesce(F.lit(hi), F.lit("2100-01-01")).cast("timestamp")
    files = data_files(spark, path, parts)
    return (
        files.filter((time >= lo) & (time < hi))
        .groupBy(*[c for c in files.columns if c not in ("path", "modificationTime")])
        .agg(F.max(time).alias("max_time"), F.min(time).alias("min_time"))
    )


def lead_partition(spark: SparkSession, path: str, part: str, ts: str) -> DataFrame:
    """Smallest partition value, as text, with a file changed after ``ts`` (a time or its text); null when there is none."""
    changed = data_files(spark, path, f"{part} string").filter(F.col("modificationTime") > F.lit(ts).cast("timestamp"))
    return changed.agg(F.min(part).alias("lead"))


def earliest_changed_bill_date(
    spark: SparkSession, sources: Sequence[tuple[str, str, str]], ts: str, glob: str = "*"
) -> DataFrame:
    """Smallest date in the names of files changed after ``ts``, over several sources.

    ``sources``: (path, pattern whose first group is the date, date format).
    """
    dates = None
    for path, pattern, fmt in sources:
        files = data_files(spark, path, glob=glob).filter(F.col("modificationTime") > F.lit(ts).cast("timestamp"))
        day = F.to_date(F.try_to_timestamp(F.regexp_extract("path", pattern, 1), F.lit(fmt)))
        found = files.select(day.alias("day"))
        dates = found if dates is None else dates.unionAll(found)
    return dates.agg(F.min("day").alias("day"))


def table_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _overwrite_partitions(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for; a large one is written by several tasks."""
    writer = df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)


def replace_where(new: DataFrame, path: str, parts: Sequence[str], predicate: Column) -> None:
    """Replace the rows that meet ``predicate``, a condition on partition columns, by ``new``.

    Only matching partitions are written: dynamic overwrite replaces those with new rows, and
    matching partitions without new rows are removed after it. ``new`` is stored first, so that
    it may be derived from the table itself. New rows outside the predicate are an error.
    """
    spark = new.sparkSession
    staged = stored(new, "replace-where")
    inside = F.bool_and(F.coalesce(predicate, F.lit(False))).alias("_inside")
    fresh = staged.groupBy(*parts).agg(inside).collect()  # one row per partition directory
    if not all(r["_inside"] for r in fresh):
        raise ValueError("rows outside the replaced range")
    if fresh:
        _overwrite_partitions(staged, path, parts)
    if not table_exists(spark, path):
        return
    kept = {tuple(r[p] for p in parts) for r in fresh}
    schema = T.StructType([T.StructField(p, staged.schema[p].dataType) for p in parts])
    directory = F.regexp_replace("path", "/[^/]+$", "").alias("_dir")
    for r in data_files(spark, path, schema).filter(predicate).select(directory, *parts).distinct().collect():
        if tuple(r[p] for p in parts) not in kept:
            stale = spark._jvm.org.apache.hadoop.fs.Path(r["_dir"])
            stale.getFileSystem(spark._jsc.hadoopConfiguration()).delete(stale, True)


def replace_by_key(new: DataFrame, path: str, keys: Sequence[str], part: str) -> None:
    """Upsert by key inside the partitions that ``new`` touches; other partitions are not read.

    Null is a partition and a key like any other. A key that ``new`` repeats within a partition is
    an error. Columns of the table that ``new`` lacks stay, and are null in new rows.
    """
    spark = new.sparkSession
    staged = stored(new, "replace-by-key")
    repeated = staged.groupBy(part, *keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"key is repeated in the new rows: {repeated[0].asDict()}")
    if table_exists(spark, path):
        # one value per partition directory that is rewritten; as literals they prune the scan
        touched = [r[0] for r in staged.select(part).distinct().collect()]
        in_touched = F.col(part).isin([v for v in touched if v is not None])
        if None in touched:
            in_touched = in_touched | F.col(part).isNull()
        found = spark.read.parquet(path).schema
        schema = T.StructType([staged.schema[part] if f.name == part else f for f in found])
        old = spark.read.schema(schema).parquet(path).filter(in_touched)
        fresh = staged.select(*[F.col(c).alias(f"_new_{c}") for c in (part, *keys)])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in (part, *keys)])
        kept = old.join(fresh, same, "left_anti")
        staged = stored(kept.unionByName(staged, allowMissingColumns=True), "replace-by-key")
    _overwrite_partitions(staged, path, [part])
