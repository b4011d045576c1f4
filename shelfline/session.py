"""Session settings and the shared folder for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables written between jobs, by application; `clear_scratch` deletes them.
_written: dict[str, list[str]] = {}


def build_session(app: str = "shelfline", **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC dates and partition-wise overwrite.

    Cluster sizing (memory, cores, shuffle partitions, checkpoint folder) belongs
    to spark-submit; ``conf`` adds or overrides single settings.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a join's hot keys even where the next step must then shuffle again.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Week and year features are both laid out by key: join them where they lie.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local master, whose driver and executors are one process, may go
    without one and gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = fallback_folder(spark.sparkContext.master)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fallback_folder(master: str) -> str:
    """A temporary folder for a local master; any other needs spark.checkpoint.dir."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused table path in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a mart to the shared folder once and go on from the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """The storage that holds a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables written between jobs, once the results drawn from them are stored."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)
