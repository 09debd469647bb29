"""Spark session helpers.

Jobs never create machine-local scratch space on a cluster: the checkpoint directory is
read from ``spark.checkpoint.dir`` (the shared folder the cluster names), and only when a job
needs one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What results depend on: UTC, so timestamp casts agree with the SQL oracle.  And what the row
# parsers need: HotSpot interprets methods over 8,000 bytes for good, so a stage whose generated
# loop is longer runs operator by operator in methods that are compiled.
BASE_CONF = {"spark.sql.session.timeZone": "UTC", "spark.sql.codegen.hugeMethodLimit": "8000"}
# Sizes and features of sessions that this module makes itself (tests, bench); a cluster's
# own settings are left alone.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "unifeed") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**BASE_CONF, **LOCAL_CONF}.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("UNIFEED_DRIVER_MEM", "8g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_conf(spark)


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the session settings that results depend on (idempotent)."""
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A single-JVM session (tests, bench) without the setting gets a temporary folder the
    first time one is needed; on a cluster a missing setting is an error."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="unifeed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back: what many branches of a
    plan read is computed once, and a lost executor re-reads files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/unifeed-scratch/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
