"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for these jobs at any scale:
# * AQE re-plans joins at run time (broadcast only when the measured side is
#   small) and splits skewed join partitions;
# * ANSI mode stays on: ratios use try_divide explicitly;
# * UTC so that no timestamp is shifted by the session zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle partitions are sized at run time from the data (AQE coalescing
    # towards ~128 MB); scans split files at 256 MB so a task's input fits
    # executor memory at any scale
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskfeat", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(shuffled_bytes: int, target_partition_bytes: int = 2 * 1024 ** 3) -> dict:
    """Initial shuffle-partition count for a cluster run, from the bytes *after* partial aggregation.

    Most blocks aggregate per user before they shuffle, so ``shuffled_bytes`` is
    far below the input. Partitions start large (2 GB; AQE splits the skewed
    ones) and their number stays between 200 and 40,000, which bounds
    map x reduce blocks; AQE coalesces small ones.
    """
    n = min(40_000, max(200, shuffled_bytes // target_partition_bytes))
    return {"spark.sql.shuffle.partitions": str(n)}


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a folder
    every executor can reach); it is an error if none is set. Only local runs
    and tests without one get a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="riskfeat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables through Spark's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
