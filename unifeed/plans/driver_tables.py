"""Adapters that present the driver's tables as the raw logs the engine reads.

The driver tables carry no hand-kept event logs, so each raw source is
*derived* from whole tables by deterministic column expressions of their
keys (text cells built by ``key % n`` choices -- every row is kept, none is
filtered).  The SQL oracle derives the same text with the same arithmetic, so
both engines start from identical raw cells and the repair logic is what is
compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_parquet

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed run date of the driver-table plans (the reference stamps "today").
PROCESSED_DATE = "2025-01-01"
# Invented personnel aliases used by the manual log B adapter (JOI3).
DEMO_ALIASES = {"vale": "Sgt. R. Vale", "moor": "Det. K. Moor", "fen": "Ofc. T. Fen"}


# Fact tables whose rows go through per-row parsing; their scans are spread
# over the cores when the file has too few splits (see ``sources.files.spread``).
SPREAD_TABLES = ("lineitem", "orders", "events", "documents", "conversations", "pages",
                 "customer", "part", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One driver table; fact tables are spread over the cores when the file has
    too few splits (``spread=False`` keeps simple predicates at the scan)."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet",
                        spread_scan=spread and name in SPREAD_TABLES)


def _case(key: Column, mod: int, *values) -> Column:
    """``CASE key % mod WHEN 0 THEN v0 WHEN 1 THEN v1 ... END``; a missing tail is NULL."""
    expr = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(key % mod == i, v) if expr is None else expr.when(key % mod == i, v)
    return expr


def _s(c: Column) -> Column:
    return c.cast("string")


def _p2(c: Column) -> Column:
    """Zero-padded two-digit text of a small non-negative integer (``%02d``)."""
    return F.lpad(c.cast("string"), 2, "0")


def _hms(seconds: Column) -> Column:
    s = seconds
    return F.concat_ws(":", _p2(F.floor(s / 3600)), _p2(F.floor((s % 3600) / 60)), _p2(s % 60))


def community_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual log A (F1 layout) from ``orders``: one event per order."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    site = F.concat(F.lit("Site "), (c % 50).cast("string"))
    return o.select(
        k.alias("row_id"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Date of Event"),
        F.when(k % 9 != 0, F.concat(_p2(8 + k % 10), F.lit(":"), _p2((k % 4) * 15))).alias("Start Time"),
        F.when(k % 13 != 0, F.concat(_p2((14 + k % 10 + c % 3) % 24), F.lit(":"), _p2((c % 4) * 15)))
         .alias("End Time"),
        F.when(k % 17 == 0, F.lit("Arrests")).when(k % 19 == 0, F.lit("Patrol (Monthly Total)"))
         .otherwise(F.col("o_orderpriority")).alias("Community Event"),
        _case(c, 3, F.upper(site), F.lower(site), F.concat(F.lit(" "), site, F.lit(" "))).alias("Event Location"),
        _case(k, 5, F.concat(_s(k % 3), F.lit(":"), _p2((k % 4) * 15)), F.lit("0 days 01:15:00"))
         .alias("Event Duration9"),
        _case(k, 6, None, "0", "2.0", "x", (c % 9).cast("string"), (c % 9).cast("string"))
         .alias("Member Count"),
    )


def stacp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual log B (F2 layout) from ``lineitem``: one event per line item."""
    li = table(spark, sf_dir, "lineitem")
    o, p, s, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    date_txt = F.when(F.year("l_shipdate") >= 2000, F.date_format("l_shipdate", "MM/dd/yy")) \
                .otherwise(F.date_format("l_shipdate", "M/d/yyyy"))
    return li.select(
        date_txt.alias("Date"),
        F.concat(_p2(7 + n), _p2((o % 4) * 15)).alias("Start Time"),
        F.concat(_s(8 + n + p % 3), F.lit(":"), _p2((p % 4) * 15)).alias("End Time"),
        _case(n, 4, F.concat(_s(1 + o % 5), F.lit(" Hrs. "), _p2((o % 2) * 30), F.lit(" Mins")), F.lit("1 Hour "),
              None, F.concat(F.lit("0 days "), _p2(p % 3), F.lit(":"), _p2((s % 4) * 15), F.lit(":00")))
         .alias("Total Time"),
        F.concat(F.lit("Site "), (s % 50).cast("string")).alias("Location"),
        F.concat(F.lit("Outreach "), F.col("l_returnflag"), F.col("l_linestatus"))
         .alias("School Outreach Conducted "),
        F.concat(F.lit("Det. Officer"), (s % 20).cast("string")).alias("Attendees"),
        F.when(p % 2 == 0, F.concat(F.lit("Unit "), (p % 7).cast("string"))).alias("Attendees2"),
        F.when(o % 5 == 0, F.lit("  ")).alias("Attendees3"),
        F.lit(None).cast("string").alias("Attendees4"),
        F.lit(None).cast("string").alias("Attendees5"),
        _case(p, 4, "Vale / Fen", "moor, Hill", None, F.concat(F.lit("Reed"), (o % 3).cast("string")))
         .alias("Free Type Attendees"),
    )


def patrol_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual log C (F3 layout) from ``customer``: January 2024 patrol events."""
    cu = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    people = _case(c, 7, None, (c % 5).cast("string"), "Squad formation",
                   F.concat(F.lit("PO Rivers"), (c % 10).cast("string"), F.lit(" / Sgt. Stone and Lake")),
                   F.concat(F.lit("P.Woods"), (c % 3).cast("string")),
                   "P.O. Woods & Det. Hill; Moor",
                   F.regexp_replace(F.col("c_name"), "#", " "))
    return cu.select(
        c.alias("row_id"),
        F.concat(F.lit("1/"), _s(1 + c % 31), F.lit("/2024")).alias("Date"),
        F.lit(None).cast("string").alias("Start Time"),
        F.lit(None).cast("string").alias("End Time"),
        F.col("c_mktsegment").alias("Event Type"),
        F.concat(F.lit("Addr "), (c % 10).cast("string")).alias("Event Name"),
        F.when(c % 10 != 0, F.concat(F.lit("Site "), (c % 50).cast("string"))).alias("Event Location"),
        people.alias("Patrol Members Assigned"),
    )


def cad_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch export (F5 layout) from ``events``: one call per event."""
    ev = table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    secs = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    back = (secs + F.floor(F.col("value") * 60)) % 86400
    return ev.select(
        F.when(e % 4 == 0, F.concat(_s(24000000 + e), F.lit(".0")))
         .otherwise((24000000 + e).cast("string")).alias("ReportNumberNew"),
        F.col("ts").alias("Time of Call"),
        F.date_format("ts", "HH:mm:ss").alias("Time Out Display"),
        F.when(e % 10 != 0, _hms(back)).alias("Time In Display"),
        F.when(e % 23 == 0, F.lit("BWC Review Q2")).otherwise(F.col("event_type")).alias("Incident"),
        F.when(u % 3 == 0, F.concat(F.lit("Site "), (u % 50).cast("string")))
         .alias("SelfJoinCADNumber::Business Name"),
        _case(u, 3, None, F.concat(_s(u % 500), F.lit(".0")), F.concat((u % 90).cast("string"), F.lit("B")))
         .alias("St Number"),
        _case(u, 4, "Main St", "Elm Ave", None, "Oak Rd").alias("StreetName"),
        F.concat(F.lit("Sgt. Ann"), _s(u % 5), F.lit(" Lane"), _s(u % 11), F.lit(" "), _s(100 + u % 50)).alias("Officer"),
        _case(e, 7, "COMM ENG", "CSB", "STA", "A2", "B3", "XYZ", None).alias("Squad"),
        F.lit("D1").alias("DispatcherNew"),
        e.alias("event_id"),
    )
