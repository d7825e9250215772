"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs are tuned for: adaptive re-planning splits the partitions of a hot
# key in joins, merges tiny ones, and turns a shuffled join into a broadcast one
# only after the size of the small side has been measured.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` (dots as `__`) wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`, the one every executor can reach.

    A machine-local folder is used only in local mode, where the driver is also
    the only executor; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="lotewise-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """`df` worked out once, written to the shared folder and read back.

    Cuts the lineage of what several later steps use; the files outlive a lost
    executor, and their size tells Spark whether the result may be broadcast.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder that `shared_dir` has named, once nothing reads it any more."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
