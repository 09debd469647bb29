"""Helpers the training-data operators share: shared scratch tables and word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in ``spark.checkpoint.dir``.

    Only a single-JVM session (tests, bench) that names none gets a temporary one;
    on a cluster a missing setting is an error, since a machine-local folder would
    hide one executor's files from the others."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="unifeed-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/llm-{spark.sparkContext.applicationId}"


def table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    every later use reads columns instead of running the plan again."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table written by :func:`table` that nothing reads any more."""
    spark = df.sparkSession
    root = scratch_root(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder and folder.rsplit("/", 1)[0].endswith(root.rsplit("/", 1)[-1]):
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(conf).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete every scratch table of this application (call once results are written)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
