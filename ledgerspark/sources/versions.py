"""Tables kept as versions, whole or by partition.

A table without a partition column adds a parquet directory with each write. With one, a write adds
only the partitions that changed, and a manifest per version names the directory of every
partition; the others stay where they are. A version counts once Spark has left the ``_SUCCESS``
file of its data or manifest, so a change is seen as a whole or not at all, a failed write is
never read, and what is being read is never overwritten. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.keys import one_per_key
from ledgerspark.session import stored
from ledgerspark.sources.files import condition_delete, condition_update, write_partitioned

MANIFEST = "directory string, layout string"
#: Names the directory of a version; no column may be called so.
VERSION = "table_version"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, part: str | None = None):
        self.spark = spark
        self.path = path
        self.part = part
        self.commits = f"{path}/_manifest" if part else path

    def _glob(self, pattern: str) -> list:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        return [f.getPath() for f in found.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(found) or []]

    def versions(self) -> list[int]:
        return sorted(int(f.getParent().getName().partition("=")[2]) for f in self._glob(f"{self.commits}/{VERSION}=*/_SUCCESS"))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None, schema: T.StructType | str | None = None) -> DataFrame:
        """A version, the latest by default; an absent table is empty with ``schema``."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], schema or T.StructType())
        if version is not None and version not in found:
            raise ValueError(f"no version {version} in {self.path}")
        version = found[-1] if version is None else version
        if not self.part:
            return self.spark.read.parquet(f"{self.path}/{VERSION}={version}")
        manifest = self._manifest(version)
        directories = [r.directory for r in manifest if r.directory]
        layout = T.StructType.fromDDL(manifest[0].layout)
        if not directories:
            return self.spark.createDataFrame([], layout)
        at = self.spark.read.option("basePath", self.path).schema(T.StructType([*layout.fields, T.StructField(VERSION, T.IntegerType())]))
        return at.parquet(*[f"{self.path}/{d}" for d in directories]).select(*layout.names)

    def _manifest(self, version: int) -> list:
        """One row per partition directory; bounded by the number of partitions."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.commits}/{VERSION}={version}").collect()

    def write(self, df: DataFrame) -> int:
        """Replace the whole table: the next version."""
        if self.part:
            return self._commit(df, None)
        version = self._next()
        df.write.mode("overwrite").parquet(f"{self.path}/{VERSION}={version}")
        return version

    def _next(self) -> int:
        found = self.versions()
        return found[-1] + 1 if found else 0

    def _commit(self, df: DataFrame, replaced: Sequence | None) -> int:
        """The next version: ``df`` in place of the partitions with the values ``replaced`` (None: of all)."""
        version, kept = self._next(), []
        if replaced is not None and version:
            gone = {self._directory_name(v) for v in replaced}
            kept = [r.directory for r in self._manifest(version - 1) if r.directory and r.directory.split("/")[1] not in gone]
        write_partitioned(df, f"{self.path}/{VERSION}={version}", self.part)
        added = [f"{VERSION}={version}/{p.getName()}" for p in self._glob(f"{self.path}/{VERSION}={version}/{self.part}=*")]
        layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        rows = [(d, layout) for d in kept + added] or [(None, layout)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.commits}/{VERSION}={version}")
        return version

    def replace_partitions(self, df: DataFrame, values: Sequence) -> int:
        """``df`` in place of the partitions with the given values, whether it has rows for them or not."""
        return self._commit(df, values)

    def _directory_name(self, value) -> str:
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return names.getPartitionPathString(self.part, None if value is None else str(value))

    def _inside(self, values: Sequence) -> Column:
        known = F.col(self.part).isin([v for v in values if v is not None])
        return known | F.col(self.part).isNull() if None in values else known

    def _touched(self, rows: DataFrame) -> list:
        """Partition values of some rows; bounded by the number of partitions."""
        return [r[0] for r in rows.select(self.part).distinct().collect()]

    def update(self, condition: Column, **values: Column) -> int:
        now = self.read()
        if not self.part:
            return self.write(condition_update(now, condition, **values))
        if self.part in values:
            raise ValueError(f"{self.part} names the partition and cannot be updated")
        touched = self._touched(now.filter(condition))
        return self._commit(condition_update(now.filter(self._inside(touched)), condition, **values), touched)

    def delete(self, condition: Column) -> int:
        now = self.read()
        if not self.part:
            return self.write(condition_delete(now, condition))
        touched = self._touched(now.filter(condition))
        return self._commit(condition_delete(now.filter(self._inside(touched)), condition), touched)

    def merge(self, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> int:
        """Matched rows take the ``update`` columns of the source, the other source rows are inserted."""
        now = self.read()
        if not self.part:
            return self.write(merge_upsert(now, source, keys, update))
        if self.part in update:
            raise ValueError(f"{self.part} names the partition and cannot be updated")
        # each source row with the partitions that hold its key: tells matches from new rows, and what is touched
        columns = [c for c in source.columns if c not in keys]
        held = now.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(self.part).alias("_part"), F.lit(True).alias("_held")).distinct()
        same = reduce(lambda a, b: a & b, [F.col(f"source_{k}") == F.col(f"_{k}") for k in keys])
        tagged = one_per_key(source, keys, columns, "source").join(held, same, "left")
        tagged = stored(tagged.select(*[f"source_{k}" for k in keys], "source", "_part", "_held"), "merge")
        place = F.when(F.col("_held"), F.col("_part")).otherwise(F.col(self.part if self.part in keys else f"source.{self.part}"))
        touched = [r[0] for r in tagged.withColumnsRenamed({f"source_{k}": k for k in keys}).select(place).distinct().collect()]
        # a matched row lies in a touched partition, so the others need not be read again
        here = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"source_{k}") for k in keys], F.col(self.part).eqNullSafe(F.col("_part")))
        merged = now.filter(self._inside(touched)).join(tagged.filter("_held"), here, "left").select(
            *[F.when(F.col("_held"), F.col(f"source.{c}")).otherwise(F.col(c)).alias(c) if c in update else c for c in now.columns]
        )
        new = tagged.filter("_held IS NULL").select(*[F.col(f"source_{k}").alias(k) for k in keys], *[F.col(f"source.{c}").alias(c) for c in columns])
        return self._commit(merged.unionByName(new, allowMissingColumns=True), touched)

    def replace_where(self, new: DataFrame, predicate: Column) -> int:
        """``new`` in place of the rows that meet ``predicate``, a condition on the partition column, at
        once. New rows outside of it are an error."""
        new = stored(new, "replace-where")
        if not new.filter(~F.coalesce(predicate, F.lit(False))).isEmpty():
            raise ValueError("rows outside the replaced range")
        gone = self._touched(self.read(schema=new.schema).filter(predicate))
        return self._commit(new, gone)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Matched rows take the ``update`` columns of the source, unmatched source rows are inserted.

    The source holds one row per key, else it is an error. Updates are a left join and inserts an
    anti join: a small source is broadcast and the target not shuffled, and with a large one AQE
    can split a hot target key, which it cannot in a full join.
    """
    s = one_per_key(source, keys, [c for c in source.columns if c not in keys], "source")

    def on(left: str, right: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"{left}{k}") == F.col(f"{right}{k}") for k in keys])

    kept = target.join(s, on("", "source_"), "left").select(
        *[
            F.when(F.col("source").isNotNull(), F.col(f"source.{c}")).otherwise(F.col(c)).alias(c) if c in update else c
            for c in target.columns
        ]
    )
    known = target.select(*[F.col(k).alias(f"target_{k}") for k in keys])
    new = s.join(known, on("source_", "target_"), "left_anti").select(
        *[F.col(f"source_{k}").alias(k) for k in keys], "source.*"
    )
    return kept.unionByName(new, allowMissingColumns=True)
