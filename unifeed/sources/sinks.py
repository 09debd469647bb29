"""Sinks and export checks (SNK1-SNK6).

Parquet is the primary sink (optionally partitioned by month so period and
window filters prune files); CSV keeps the reference's core-then-extras
column order.  Every result table is written by the executors; nothing is
collected to the driver.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import order_columns


# Lossless CSV: RFC-4180 quote doubling, no whitespace trimming on write (Spark
# trims by default), multi-line cells read back as one record.
CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {"header": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def run_stamp(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_feed(df: DataFrame, path: str, fmt: str = "parquet", partition_by_month: bool = True,
               mode: str = "overwrite") -> str:
    """SNK1: the canonical feed, core columns first.  Parquet output is
    partitioned by ``year_month`` so FLT3/FLT4 read only the months they need."""
    out = order_columns(df)
    w = out
    if partition_by_month and "date" in out.columns:
        w = out.withColumn("year_month", F.date_format("date", "yyyy-MM"))
    writer = w.write.mode(mode)
    if partition_by_month and "date" in out.columns:
        writer = writer.partitionBy("year_month")
    if fmt == "csv":
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> dict[str, str]:
    """SNK2-SNK5: one directory per result table (combined feed, run summary,
    office summary, reconciliation, imputed, unrouted, proposals, ...)."""
    paths = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        w = df.write.mode(mode)
        if fmt == "csv":
            w.options(**CSV_WRITE).csv(p)
        else:
            w.format(fmt).save(p)
        paths[name] = p
    return paths


def write_sorted(df: DataFrame, path: str, *cols: str) -> str:
    """SRT1: one global order over the files (ranges of the sort key, files in name order)."""
    df.orderBy(*cols).write.mode("overwrite").parquet(path)
    return path


def update_months(df: DataFrame, path: str, date_col: str = "date") -> str:
    """SNK1: replace the months that ``df`` has rows of in a feed partitioned by ``year_month``; files
    of all other months are not touched.  Rows are dealt by month and ranges of the date, so a busy
    month is written by several tasks and each file holds a range of days."""
    out = order_columns(df).withColumn("year_month", F.date_format(date_col, "yyyy-MM"))
    (out.repartitionByRange("year_month", date_col).sortWithinPartitions("year_month", date_col)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month").parquet(path))
    return path


def digest_columns(df: DataFrame) -> list:
    """Aggregates that tell multisets of rows apart in any order: the count and sums of two row
    hashes (NULL is told from blank, cells from their neighbours).  Rows changed, doubled, lost or
    with cells swapped change them, but for a chance of about 2^-100."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    if not cells:
        return [F.count(F.lit(1)).alias("rows"), F.lit(None).cast("decimal(38,0)").alias("sum1"),
                F.lit(None).cast("decimal(38,0)").alias("sum2"), F.array().cast("array<bigint>").alias("nulls")]
    nulls = [c.isNull() for c in cells]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *cells, *nulls).cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("rows"), total(1).alias("sum1"), total(2).alias("sum2"),
            F.array(*[F.count_if(x) for x in nulls]).alias("nulls")]


def digest(df: DataFrame) -> DataFrame:
    """One row: the multiset digest of a frame (:func:`digest_columns`)."""
    return df.agg(*digest_columns(df))


def checked_write(df: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """SNK6 with one pass a side: write ``df``, digesting it while it is written, read it back and
    digest what was read.  Returns rows out and in, whether columns, NULL counts and contents are
    the same, and ``ok``.  Floats are compared bit by bit (a lossy text format shows)."""
    seen = Observation()
    first, *rest = digest_columns(df)
    w = df.observe(seen, first, *rest).write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
        back = df.sparkSession.read.schema(df.schema).options(**CSV_READ).csv(path)
    else:
        w.format(fmt).save(path)
        back = df.sparkSession.read.format(fmt).load(path)
    out, same = seen.get, [c for c in back.columns if c in df.columns] == list(df.columns) == back.columns
    got = digest(back).first().asDict()
    return {"rows_out": out["rows"], "rows_in": got["rows"], "same_columns": same,
            "same_nulls": list(out["nulls"]) == list(got["nulls"]),
            "same_content": (out["sum1"], out["sum2"]) == (got["sum1"], got["sum2"]),
            "ok": same and out == got}


def run_summary(spark: SparkSession, feed: DataFrame, sources: list[str], errors: list[str],
                started: _dt.datetime) -> DataFrame:
    """SNK4: one-row run summary (start, sources, records, quality score, errors).

    Record count and score are aggregated by Spark; only the source names and
    error texts (a handful of strings) come from the driver."""
    from ..operators.quality import combined_score
    s = combined_score(feed)
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return s.select(F.lit(started).cast("timestamp").alias("started"), texts(sources).alias("sources"),
                    texts(errors).alias("errors"), "*")


def roundtrip_check(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """SNK6: write ``df``, read it back and compare shape, column names,
    per-column NULL counts and content (``exceptAll`` both ways); one row.

    Runs entirely on the executors: both frames are aggregated in one pass
    each and the row-level difference is counted, never listed."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
        back = df.sparkSession.read.schema(df.schema).options(**CSV_READ).csv(path)
    else:
        w.format(fmt).save(path)
        back = df.sparkSession.read.format(fmt).load(path)
    cols = df.columns

    def nulls(x: DataFrame):
        return F.array(*[F.count_if(F.col(f"`{c}`").isNull()) for c in cols])

    # the written side is the main row; the read-back side and both
    # differences are scalar subqueries (no join of one-row frames)
    back_stats = back.agg(F.struct(F.count(F.lit(1)).alias("rows"), nulls(back).alias("nulls"))).scalar()
    lost = df.exceptAll(back).agg(F.count(F.lit(1))).scalar()
    added = back.exceptAll(df).agg(F.count(F.lit(1))).scalar()
    same_cols = back.columns == cols
    j = df.agg(F.count(F.lit(1)).alias("rows_out"), nulls(df).alias("nulls_out")).select(
        "rows_out", back_stats["rows"].alias("rows_in"), "nulls_out", back_stats["nulls"].alias("nulls_in"),
        lost.alias("rows_lost"), added.alias("rows_added"))
    return j.select("rows_out", "rows_in", F.lit(same_cols).alias("same_columns"),
                    (F.col("nulls_out") == F.col("nulls_in")).alias("same_nulls"),
                    "rows_lost", "rows_added",
                    ((F.col("rows_out") == F.col("rows_in")) & F.lit(same_cols)
                     & (F.col("nulls_out") == F.col("nulls_in"))
                     & (F.col("rows_lost") == 0) & (F.col("rows_added") == 0)).alias("ok"))
