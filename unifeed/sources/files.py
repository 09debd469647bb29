"""File scans: parquet / delimited readers, newest-file selection, file-name
periods, scan spreading (SRC2, SRC3, SRC6, SRC7, QLT11 input)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import period_from_file_name


#: A scan of this many splits is never dealt anew, however many cores there are, so what
#: ``spread`` shuffles is bounded (32 splits of 128 MB).
MAX_SPREAD = 32


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least ``min_partitions`` (default: the cluster's default
    parallelism) partitions before CPU-heavy per-row parsing.

    A file stored as one row group is read by one task; the round-robin
    repartition lets every core parse it.  When the scan already has enough
    splits -- the normal case for large inputs -- the frame is returned as
    is and nothing is added.

    When it does repartition, a row-preserving filter on the partition id
    (always true, but non-deterministic to the optimizer) sits above the
    exchange, so predicates on *derived* columns (a parsed date, a
    contamination rule) are evaluated by all tasks after the spread instead
    of being pushed into the single scan task.  Column pruning still reaches
    the scan.
    """
    spark = df.sparkSession
    target = min_partitions or min(spark.sparkContext.defaultParallelism, MAX_SPREAD)
    try:
        n = df.rdd.getNumPartitions()
    except Exception:  # e.g. a client session without RDD access
        return df
    if n >= target:
        return df
    return df.repartition(target).where(F.spark_partition_id() >= 0)


def keep_above(df: DataFrame) -> DataFrame:
    """``df`` with its projection held: a predicate is not pushed through a projection with a
    non-deterministic column (the partition id, always >= 0 and read by a filter so that it is not
    pruned), so filters on the columns of ``df`` read their values instead of copying the
    expressions behind them.  Row-preserving; column pruning passes it."""
    return df.withColumn("_held", F.spark_partition_id()).where(F.col("_held") >= 0).drop("_held")


def read_parquet(spark: SparkSession, path: str | Sequence[str], spread_scan: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return spread(df) if spread_scan else df


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                   schema: T.StructType | None = None, header: bool = True,
                   multi_line: bool = False) -> DataFrame:
    """SRC2 / SRC3: delimited text with a header, every cell read as text unless a
    schema is given (no inference pass over the data).  A UTF-8 byte-order
    mark on the first header is removed.  Files are split over tasks by line;
    ``multi_line`` reads each file whole, for cells with line breaks inside quotes."""
    paths = [path] if isinstance(path, str) else list(path)
    r = (spark.read.option("header", header).option("sep", sep).option("multiLine", multi_line)
         .option("escape", '"').option("encoding", "UTF-8"))
    df = r.schema(schema).csv(paths) if schema is not None else r.option("inferSchema", False).csv(paths)
    first = df.columns[0] if df.columns else None
    if first is not None and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    return df


def with_source_file(df: DataFrame) -> DataFrame:
    """Attach the source file name, modification time and period (SRC7) from
    the scan's hidden ``_metadata`` column."""
    return df.select("*", F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_modification_time").alias("source_mtime"),
                     period_from_file_name(F.col("_metadata.file_name")).alias("source_period"))


def list_files(spark: SparkSession, pattern: str, modified_after: str | None = None) -> DataFrame:
    """Catalogue of files matching a glob: path, name, modification time, size
    (``binaryFile`` with the content column pruned away, so no bytes are read)."""
    r = spark.read.format("binaryFile")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    df = r.load(pattern).select("path", "modificationTime", "length")
    return df.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def newest_file(files: DataFrame, by: str = "mtime") -> DataFrame:
    """SRC6: the newest file as a one-row frame -- by modification time (ties
    broken by path) or by name (the highest name wins)."""
    if by == "name":
        key = F.struct(F.col("file_name"), F.col("path"))
    else:
        key = F.struct(F.col("modificationTime"), F.col("path"))
    return files.agg(F.max_by("path", key).alias("path"))


def count_tokens_in_logs(spark: SparkSession, pattern: str, token: str = "ERROR",
                         modified_after: str | None = None, alert_above: int = 10) -> DataFrame:
    """QLT11: occurrences of ``token`` over log files (optionally only recent
    ones), with the alert flag; one row."""
    r = spark.read.format("text")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    return count_tokens(r.load(pattern), "value", token, alert_above)


def count_tokens(lines: DataFrame, text_col: str, token: str, alert_above: int = 10) -> DataFrame:
    """QLT11 on any frame of lines: occurrences of ``token``, lines, alert flag; one row."""
    hits = F.regexp_count(F.col(text_col), F.lit("\\Q" + token + "\\E"))
    agg = lines.agg(F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("token_hits"),
                    F.count(F.lit(1)).alias("lines"))
    return agg.withColumn("alert", F.col("token_hits") > alert_above)
