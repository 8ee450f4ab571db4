"""Readers and writers for the plain file formats."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.session import new_path

def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema one more pass over the files infers it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def json_strings_to_table(df: DataFrame, col: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A column of JSON objects as a table, one row per row.

    Without ``schema`` the JSON reader's own inference runs over all rows, in the JVM, and returns
    one schema to the driver: decimals are doubles, mixed types text, fields that are only ever null
    text, and no rows no columns.
    """
    if schema is None:
        spark = df.sparkSession
        texts = getattr(df.select(F.col(col).cast("string")).filter(F.col(col).isNotNull())._jdf, "as")
        found = spark._jsparkSession.read().json(texts(spark._jvm.org.apache.spark.sql.Encoders.STRING())).schema()
        schema = T.StructType.fromJson(json.loads(found.json()))
    if not len(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema):
        return df.select()
    return df.select(F.from_json(col, schema).alias("_row")).select("_row.*")


def scan_text_split(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Text lines split on ``sep``, trimmed and cast; what does not cast is null."""
    parts = F.split("value", sep)
    return spark.read.text(path).select(
        *[F.trim(F.get(parts, F.lit(i))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def allow_charset(spark: SparkSession, encoding: str) -> None:
    """Spark reads only the Unicode and Latin charsets unless the session allows those of the JDK."""
    if not encoding.lower().startswith(("utf", "us-ascii", "iso-8859-1")):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def scan_csv(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8", **options) -> DataFrame:
    """CSV with ``sep, comment, encoding, header, inferSchema``; paths may be globs."""
    allow_charset(spark, encoding)
    return spark.read.options(encoding=encoding, **options).csv(paths)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite", **options) -> None:
    allow_charset(df.sparkSession, encoding)
    df.write.options(encoding=encoding, **options).mode(mode).csv(path)


def write_orc(df: DataFrame, path: str, bloom: str, dictionary: str, fpp: float = 0.05) -> None:
    df.write.format("orc").option("orc.bloom.filter.columns", bloom).option("orc.bloom.filter.fpp", fpp).option(
        "orc.dictionary.key.threshold", "1.0"
    ).option("orc.column.encoding.direct", dictionary).mode("overwrite").save(path)


def sql_on_file(spark: SparkSession, path: str, select: str, where: str = "true") -> DataFrame:
    return spark.sql(f"SELECT {select} FROM parquet.`{path}` WHERE {where}")


def local_rows_to_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_partitioned(df: DataFrame, path: str, *parts: str, mode: str = "overwrite") -> None:
    """One file per partition value and task that holds it; ``rebalance`` splits a hot value over
    several files and packs small ones."""
    df.hint("rebalance", *parts).write.partitionBy(*parts).mode(mode).parquet(path)


def write_bucketed(df: DataFrame, key: str, buckets: int, parts: Sequence[str] = ()) -> str:
    """Save as a bucketed, sorted table in the shared folder, within partitions by ``parts`` if given; returns its name.

    Two tables with the same buckets join on the key without a shuffle. Rows are brought together
    by bucket first, so that a bucket gets few files; ``rebalance`` spreads a bucket that a hot
    key fills over several.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    grouped = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", *parts, "_bucket").drop("_bucket")
    writer = grouped.write.bucketBy(buckets, key).sortBy(key)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.option("path", new_path(df.sparkSession, name)).saveAsTable(name)
    return name


def create_table_as(spark: SparkSession, select: DataFrame) -> str:
    """CREATE TABLE ... AS SELECT, in the shared folder; returns the table's name."""
    name = f"ctas_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} USING parquet LOCATION '{new_path(spark, name)}' AS SELECT * FROM {{select}}", select=select
    )
    return name


def create_table_like(spark: SparkSession, source: str) -> str:
    """An empty table with the columns of ``source``."""
    name = f"like_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} LIKE {source} USING parquet LOCATION '{new_path(spark, name)}'")
    return name


def audit_rows(inserted: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """What an insert leaves in the audit table: (id, name) of each new row."""
    return inserted.select(F.col(id_col).alias("emp_no"), F.col(name_col).alias("name"))


def insert_with_audit(inserted: DataFrame, table_path: str, audit_path: str, id_col: str, name_col: str) -> None:
    """Append rows to a table and their (id, name) to its audit table."""
    inserted.write.mode("append").parquet(table_path)
    audit_rows(inserted, id_col, name_col).write.mode("append").parquet(audit_path)


def write_classes(df: DataFrame, path: str, by: str) -> DataFrame:
    """Write each class of rows to its own directory and return the rows written per class.

    The counts are read back from what was written: counters kept by tasks would count a retried
    task twice.
    """
    write_partitioned(df, path, by)
    return df.sparkSession.read.schema(df.schema).parquet(path).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def condition_update(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows for which the condition is false or null stay."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def condition_delete(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE: rows for which the condition is false or null stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def keep_min_per_key(df: DataFrame, id_col: str, *key: str) -> DataFrame:
    """Delete duplicates, keeping the row with the smallest id of each key."""
    rest = [c for c in df.columns if c not in key and c != id_col]
    kept = df.groupBy(*key).agg(F.min(F.struct(id_col, *rest)).alias("_row"))
    return kept.select(*key, "_row.*").select(*df.columns)
