"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_root: str | None = None


def build_session(app_name: str = "clickwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # methods above 8000 bytes are never compiled by the JVM; split them instead
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event time is UTC throughout; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local-mode session may go without the setting; a cluster must name it.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="clickwatch-")
    return _local_root


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/clickwatch/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` once as a parquet table in the shared folder and read it back.

    Cuts the lineage at a point that several later passes start from. The table
    outlives executors, and later scans prune its columns and row groups.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_all_cores(df: DataFrame) -> DataFrame:
    """Spread an input of few, large pieces over the cores before costly work per row.

    Only when that at least doubles the tasks; a table of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def drop_staged(spark: SparkSession) -> None:
    """Remove what this application has staged, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/clickwatch/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
