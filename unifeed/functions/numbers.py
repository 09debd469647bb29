"""Numeric and conditional scalars (NUM1, NUM4, NUM6) and the squad route table (NUM5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_, to_double

# Squad routing of dispatch rows (NUM5).
#   squad      include  office                  division
ROUTE_ROWS = (
    ("COMM ENG", True, "Community Engagement", "Outreach"),
    ("CSB", False, "", ""),
    ("STA", True, "STA&CP", "STACP"),
    ("A1", True, "Patrol", "Patrol"),
    ("A2", True, "Patrol", "Patrol"),
    ("A3", True, "Patrol", "Patrol"),
    ("A4", True, "Patrol", "Patrol"),
    ("B1", True, "Patrol", "Patrol"),
    ("B2", True, "Patrol", "Patrol"),
    ("B3", True, "Patrol", "Patrol"),
    ("B4", True, "Patrol", "Patrol"),
)
ROUTE_SCHEMA = T.StructType([
    T.StructField("squad", T.StringType(), False),
    T.StructField("include", T.BooleanType(), False),
    T.StructField("route_office", T.StringType(), False),
    T.StructField("route_division", T.StringType(), False),
])


def route_table(spark: SparkSession, rows=ROUTE_ROWS) -> DataFrame:
    """The route table as a (tiny, fixed-size) DataFrame -- safe to broadcast."""
    return spark.createDataFrame(list(rows), ROUTE_SCHEMA)


def round_half_even(c, scale: int = 2) -> Column:
    """Round half-even the way pandas/numpy ``round`` does: ``rint(x * 10**s) / 10**s``.

    This differs from ``bround`` (which rounds the shortest decimal form) on
    binary ties such as 0.575 -> 0.57; the reference rounds with numpy.
    """
    f = float(10 ** scale)
    return F.rint(col_(c) * f) / f


def given_head_count(c) -> Column:
    """NUM1: ``max(int(float(x)), 1)``; NULL or unparseable -> 1."""
    n = to_double(c).try_cast(T.LongType())
    return F.greatest(F.coalesce(n, F.lit(1).cast("long")), F.lit(1).cast("long"))


def clamp_presentation_count(c, numeric: bool = False) -> Column:
    """NUM4: NULL, <=0 or unparseable -> 1; else the whole number.  ``numeric``: the column holds
    whole numbers already, so no text is parsed."""
    x = col_(c)
    n = (x.cast(T.DoubleType()) if numeric else to_double(x.cast("string"))).try_cast(T.LongType())
    return F.when(n.isNull() | (n <= 0), F.lit(1).cast("long")).otherwise(n)


def pct(part, whole, scale: int = 1) -> Column:
    """NUM6: percentage with banker's rounding; empty denominator -> 0."""
    w = col_(whole)
    return F.when(w > 0, round_half_even(col_(part) * 100.0 / w, scale)).otherwise(F.lit(0.0))
