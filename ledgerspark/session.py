"""Session-level helpers: input tables and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for an application, so that they need
    neither the driver's working directory nor its path."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="ledgerspark-code-")  # the driver serves the archive from here
        root, name = os.path.split(package)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", root, name))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ledgerspark-")
    return _local_dirs[app]


_app_dirs: set[str] = set()


def app_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one; Hadoop removes it when the driver ends."""
    path = f"{shared_dir(spark)}/ledgerspark-{spark.sparkContext.applicationId}"
    if path not in _app_dirs:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _app_dirs.add(path)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the application's folder that nothing has been written to yet."""
    return f"{app_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly, for costly work on rows that a file holds in a few large row groups."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def parts_of(df: DataFrame, rows: int = 1 << 20) -> int:
    """As many partitions as give each about ``rows`` of ``df``, and no fewer than a shuffle has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def cents(amount: Column) -> Column:
    """Double money amount to whole cents."""
    return F.round(amount * 100).cast("bigint")
