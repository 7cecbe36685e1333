"""Latest-value table as a log of small upserts that is folded into snapshots.

Each micro-batch writes its newest rows per key below its query's id and its own
number, so a repeated batch replaces itself and a query with a new checkpoint
never meets another's files. `compact`, run on a schedule, writes a snapshot
of all that is there; the log folders a snapshot covers are removed by the compaction
after it, so that readers that listed them meanwhile still find them. Readers take the
newest row per key over snapshots and log, which is right before, during and after a compaction.
An expired key has a tombstone (`gone`), dated after its last row, which readers leave out; a
compaction keeps it, since the folders it covers are still there.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwatch.operators.feature_store import latest_per_key, online_rows
from clickwatch.schemas import ONLINE_FEATURE

INTERVAL = "since BIGINT, until BIGINT"
QUERY_ID = "sql.streaming.queryId"
_LOGGED = T.StructType([*ONLINE_FEATURE.fields, T.StructField("gone", T.BooleanType())])


def upsert(rows: DataFrame, batch_id: int, root: str) -> None:
    query = rows.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "batch"
    gone = [] if "gone" in rows.columns else [F.lit(False).alias("gone")]
    newest = latest_per_key(rows.select("*", *gone), "event_timestamp").select(*_LOGGED.fieldNames())
    newest.write.mode("overwrite").parquet(f"{root}/log/{query}/{batch_id}")


def _newest(spark: SparkSession, root: str) -> DataFrame:
    log = spark.read.schema(_LOGGED).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)
    return latest_per_key(log, "event_timestamp")


def read_online(spark: SparkSession, root: str) -> DataFrame:
    return _newest(spark, root).filter(~F.coalesce("gone", F.lit(False))).drop("gone")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def materialized_intervals(spark: SparkSession, root: str) -> DataFrame:
    """Intervals (since, until] of window ends, in microseconds, that are in the table; since is NULL for the first."""
    path = f"{root}/intervals"
    if not _exists(spark, path):
        return spark.createDataFrame([], INTERVAL)
    return spark.read.schema(INTERVAL).option("recursiveFileLookup", "true").json(path)


def materialize_next(features: DataFrame, root: str, as_of: int) -> bool:
    """Take in the feature rows that ended since the last committed run and by `as_of` (microseconds).

    The interval is committed after its rows are written, each under its end, so a run that was cut off is done
    again from the same start and replaces its own rows; a run up to a time already reached does nothing. One
    materialisation of a table runs at a time.
    """
    spark = features.sparkSession
    since = materialized_intervals(spark, root).agg(F.max("until")).first()[0]
    if since is not None and as_of <= since:
        return False
    ended = F.unix_micros("window_end")
    fresh = features.filter(ended <= as_of) if since is None else features.filter((ended > since) & (ended <= as_of))
    newest = latest_per_key(online_rows(fresh), "event_timestamp").withColumn("gone", F.lit(False))
    newest.select(*_LOGGED.fieldNames()).write.mode("overwrite").parquet(f"{root}/log/materialized/{as_of}")
    done = spark.createDataFrame([(since, as_of)], INTERVAL)
    done.coalesce(1).write.mode("overwrite").json(f"{root}/intervals/{as_of}")
    return True


def _folders(spark: SparkSession, root: str) -> tuple[object, list[str]]:
    """(file system, all batch and snapshot folders)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for pattern in ("log/*/*", "snapshot/*"):
        found += [str(s.getPath()) for s in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}"))]
    return files, found


def compact(spark: SparkSession, root: str) -> None:
    """Write a snapshot, and remove the folders that the snapshot before it covered."""
    jvm = spark.sparkContext._jvm
    files, covered = _folders(spark, root)
    done = f"{root}/covered"
    earlier = files.exists(jvm.org.apache.hadoop.fs.Path(done))
    old = [r.value for r in spark.read.text(done).collect()] if earlier else []  # folder names of one compaction
    snapshot = f"{root}/snapshot/{time.time_ns()}"
    _newest(spark, root).write.parquet(snapshot)
    for folder in set(old) & set(covered):
        files.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    names = spark.createDataFrame([(f,) for f in covered if f not in old], "value STRING")
    names.coalesce(1).write.mode("overwrite").text(done)
