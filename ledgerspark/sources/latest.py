"""Latest entry of each key: a base in buckets, and small tables of what changed since.

Each batch adds a table of its changed keys only. Now and then these are folded into the base, where only the
buckets of changed keys are written again. A key's entries have rising numbers, so reading base and
changes together, newest first, is right at any moment, also between the two steps of a fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import stored
from ledgerspark.sources.partitions import table_exists
from ledgerspark.sources.versions import VersionedTable

#: Column that is true in an entry that removes its key, and the batch that a change came with.
GONE, BATCH = "gone", "batch"


class LatestTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], log_id: str, buckets: int = 64):
        self.spark, self.keys, self.log_id, self.buckets = spark, list(keys), log_id, buckets
        self.base = VersionedTable(spark, f"{path}/base", "bucket")
        self.changes, self.folds = f"{path}/changes", f"{path}/folds"

    def add(self, changed: DataFrame, batch: int) -> None:
        """Changed rows of a batch, with GONE; a repeated batch replaces itself."""
        changed.write.mode("overwrite").parquet(f"{self.changes}/{BATCH}={batch}")

    def _folded(self) -> int:
        """Last batch that the base holds, -1 at first."""
        if not table_exists(self.spark, self.folds):
            return -1
        return self.spark.read.schema("upto bigint").parquet(self.folds).agg(F.max("upto")).first()[0]

    def _pending(self) -> DataFrame | None:
        if not table_exists(self.spark, self.changes):
            return None
        # the batch is a directory, so folded ones are not opened
        return self.spark.read.parquet(self.changes).filter(F.col(BATCH) > self._folded())

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), self.log_id).alias("_l")).select(*self.keys, "_l.*")

    def read(self) -> DataFrame:
        """One row per key that is there, without GONE; an absent table has no columns."""
        pending = self._pending()
        if pending is None:
            return self.spark.createDataFrame([], "bucket int").drop("bucket")
        rows = pending.drop(BATCH)
        if self.base.exists():
            rows = rows.unionByName(self.base.read().drop("bucket").withColumn(GONE, F.lit(False)))
        return self._newest(rows).filter(~F.col(GONE)).drop(GONE)

    def fold(self) -> list[int]:
        """Bring the changes into the base; returns the buckets that were written again."""
        pending = self._pending()
        if pending is None:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = stored(self._newest(pending).withColumn("bucket", bucket), "changes")
        last = rows.agg(F.max(BATCH)).first()[0]
        if last is None:
            return []
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # at most ``buckets``
        rows = rows.drop(BATCH)
        if self.base.exists():
            known = self.base.read().filter(F.col("bucket").isin(touched))
            rows = rows.unionByName(known.withColumn(GONE, F.lit(False)))
        kept = self._newest(rows).filter(~F.col(GONE)).drop(GONE)
        self.base.replace_partitions(kept, touched)
        self.spark.createDataFrame([(last,)], "upto bigint").coalesce(1).write.mode("append").parquet(self.folds)
        return touched
