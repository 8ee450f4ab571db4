"""Change logs that are replayed from where the last run ended.

A run reads the log's entries after its high-water mark, the states of the entities they touch (by
bucket), and writes those buckets again. What a run finds for good (values that ended, entries that do not
fit) is added to a table of results. Mark and results carry the number of the state's version, which is
written last and seen as a whole, so a run that fails in between is repeated without a trace.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.changelog import changelog_check_before, changelog_rebuild_state
from ledgerspark.session import stored
from ledgerspark.sources.versions import VersionedTable

#: state rows known so far and new entries -> state rows, results
Step = Callable[[DataFrame | None, DataFrame], tuple[DataFrame, DataFrame]]


class ReplayedLog:
    """State per entity of a log with rising entry numbers ``log_id``; late entries, at or below the mark, are not read."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], log_id: str = "log_id", buckets: int = 64):
        self.spark, self.path, self.keys, self.log_id, self.buckets = spark, path, list(keys), log_id, buckets
        self.state = VersionedTable(spark, f"{path}/state", "bucket")

    def mark(self) -> int | None:
        """Number of the last entry that the state holds, None at first."""
        found = self.state.versions()
        return self.spark.read.schema("mark bigint").parquet(f"{self.path}/marks/run={found[-1]}").first()[0] if found else None

    def advance(self, log: DataFrame, step: Step) -> list[int]:
        """Read what is new in ``log``; returns the buckets that were read and written, none when nothing is new."""
        mark, versions = self.mark(), self.state.versions()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = log if mark is None else log.filter(F.col(self.log_id) > mark)
        tail = stored(new.filter(F.col(self.log_id).isNotNull()).withColumn("bucket", bucket), "tail")
        touched = sorted(r.bucket for r in tail.select("bucket").distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        known = self.state.read().filter(F.col("bucket").isin(touched)).drop("bucket") if versions else None
        state, results = step(known, tail.drop("bucket"))
        run = versions[-1] + 1 if versions else 0
        results.write.mode("overwrite").parquet(f"{self.path}/results/run={run}")
        tail.agg(F.max(self.log_id).cast("bigint").alias("mark")).write.mode("overwrite").parquet(f"{self.path}/marks/run={run}")
        self.state.replace_partitions(state.withColumn("bucket", bucket), touched)
        return touched

    def states(self, version: int | None = None) -> DataFrame:
        return self.state.read(version).drop("bucket")

    def results(self) -> DataFrame:
        """What all runs have found; a run that did not end has no part in it."""
        return self.spark.read.parquet(f"{self.path}/results").filter(F.col("run") <= self.state.versions()[-1]).drop("run")

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in self.keys])


class ReplayedState(ReplayedLog):
    """Values of a log (keys, log_id, op, values) with the entries in which they hold, as of ``changelog_rebuild_state``.

    The state has the values that hold now, the results those that ended.
    """

    def read(self, log: DataFrame) -> list[int]:
        return self.advance(log, self._step)

    def _step(self, known: DataFrame | None, tail: DataFrame) -> tuple[DataFrame, DataFrame]:
        rebuilt = changelog_rebuild_state(tail, self.keys, self.log_id)
        now, ended = rebuilt.filter("valid_to IS NULL").drop("valid_to"), rebuilt.filter("valid_to IS NOT NULL")
        if known is None:
            return now, ended
        reset = F.min(F.when(F.col("op") != "add", F.col(self.log_id))).alias("valid_to")
        resets = tail.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(reset)
        held = known.join(resets, self._same(known, resets), "left").select(*known.columns, "valid_to")
        return (
            held.filter("valid_to IS NULL").drop("valid_to").unionByName(now),
            held.filter("valid_to IS NOT NULL").select(*ended.columns).unionByName(ended),
        )

    def values(self, version: int | None = None) -> DataFrame:
        """Values that hold after a run, the last by default, with a null ``valid_to``."""
        return self.states(version).withColumn("valid_to", F.lit(None).cast("bigint"))

    def rebuilt(self) -> DataFrame:
        """All values since the log began, as a full rebuild gives them."""
        return self.results().unionByName(self.values())


class CheckedLog(ReplayedLog):
    """Entries of a log (keys, log_id, before, after) whose ``before`` is not what the entry before them left.

    The state has the last entry of each entity, the results the entries found.
    """

    def read(self, log: DataFrame) -> list[int]:
        return self.advance(log, self._step)

    def _step(self, known: DataFrame | None, tail: DataFrame) -> tuple[DataFrame, DataFrame]:
        tail = tail.select(*self.keys, self.log_id, "before", "after")
        entries = tail
        if known is not None:
            entries = tail.unionByName(known.withColumn("before", F.lit(None).cast(tail.schema["before"].dataType)))
        last = entries.groupBy(*self.keys).agg(F.max_by(F.struct(self.log_id, "after"), self.log_id).alias("l")).select(*self.keys, "l.*")
        found = changelog_check_before(entries, self.keys, self.log_id)
        mark = self.mark()
        return last, found if mark is None else found.filter(F.col(self.log_id) > mark)
