"""Job state: when a job last ran, kept as a table."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

STATE = "job string, last_run timestamp"


def write_last_run(spark: SparkSession, path: str, job: str, last_run: Column) -> None:
    """Add the time that a run of the job has seen; earlier ones stay as its history."""
    spark.range(1).select(F.lit(job).alias("job"), last_run.cast("timestamp").alias("last_run")).write.mode("append").parquet(path)


def read_last_run(spark: SparkSession, path: str, job: str, first: str = "2000-01-01"):
    """Latest time of the job; ``first`` when the table or the job is new."""
    state = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = state.getFileSystem(spark._jsc.hadoopConfiguration()).exists(state)
    rows = spark.read.schema(STATE).parquet(path) if known else spark.createDataFrame([], STATE)
    return rows.filter(F.col("job") == job).agg(F.coalesce(F.max("last_run"), F.lit(first).cast("timestamp"))).first()[0]
