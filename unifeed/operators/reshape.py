"""Count grid -> events (REL4, FLT6, SRC8)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import period_from_sheet_name

DAY_LABELS = tuple(str(d) for d in range(1, 32))
TOTAL_LABEL = "Total"
# Fixed values of the events a grid cell becomes (REL4).
GRID_LOCATION = "Various"
GRID_START, GRID_END, GRID_HOURS = "08:00", "17:00", 8.0


def grid_to_events(grid: DataFrame, sheet_col: str = "sheet", activity_col: str = "activity",
                   day_cols: Sequence[str] = DAY_LABELS, total_col: str | None = TOTAL_LABEL,
                   office: str | None = None, division: str | None = None) -> tuple[DataFrame, DataFrame]:
    """REL4: one event per (activity, day) cell with a count > 0.

    The month comes from the sheet name (SRC8).  ``Total`` becomes an event on
    the first of the month named ``<activity> (Monthly Total)``.  Rows with a
    blank activity are skipped (FLT6); cells whose text is not a number, or
    whose day does not exist in that month, go to the returned rejects frame
    instead of failing the source.
    Returns ``(events, rejects)``.
    """
    values = [c for c in day_cols if c in grid.columns]
    if total_col and total_col in grid.columns:
        values.append(total_col)
    g = grid.where(F.col(activity_col).isNotNull() & (F.trim(F.col(activity_col)) != ""))
    g = g.select(sheet_col, activity_col,
                 *[F.col(f"`{v}`").cast("string").alias(v) for v in values])
    long = g.unpivot([sheet_col, activity_col], values, "day_label", "cell")
    cnt = long.select("*", F.col("cell").try_cast(T.DoubleType()).alias("n"),
                      period_from_sheet_name(F.col(sheet_col)).alias("period"))
    is_total = F.col("day_label") == F.lit(total_col or "")
    day = F.when(is_total, F.lit(1)).otherwise(F.col("day_label").try_cast(T.IntegerType()))
    date = F.format_string("%04d-%02d-%02d", F.year("period"), F.month("period"), day) \
        .try_cast(T.DateType())
    withd = cnt.select("*", date.alias("date"))
    nonblank_cell = F.col("cell").isNotNull() & (F.trim(F.col("cell")) != "")
    bad = nonblank_cell & (F.col("n").isNull() | ((F.col("n") > 0) & F.col("date").isNull()))
    rejects = withd.where(bad).select(sheet_col, activity_col, "day_label", "cell")
    ok = withd.where(~bad & (F.col("n") > 0))
    name = F.when(is_total, F.concat(F.col(activity_col), F.lit(" (Monthly Total)"))) \
        .otherwise(F.col(activity_col))
    events = ok.select(
        F.col("date"),
        F.lit(GRID_START).alias("start_time"),
        F.lit(GRID_END).alias("end_time"),
        name.alias("event_name"),
        F.lit(GRID_LOCATION).alias("location"),
        F.lit(GRID_HOURS).alias("duration_hours"),
        F.col("n").cast("long").alias("attendee_count"),
        F.lit(office).cast("string").alias("office"),
        F.lit(division).cast("string").alias("division"),
        F.lit("").alias("attendee_names"),
        F.col(sheet_col).alias("sheet"),
    )
    return events, rejects


def counts_to_grid(df: DataFrame, sheet_col: str, activity_col: str, day_col: str,
                   with_total: bool = True) -> DataFrame:
    """Build a day-by-activity count grid (the inverse of :func:`grid_to_events`):
    ``groupBy(sheet, activity).pivot(day, 1..31)`` with an explicit value list
    (no distinct pass) plus a ``Total`` column."""
    days = list(range(1, 32))
    grid = df.groupBy(sheet_col, activity_col).pivot(day_col, days).agg(F.count(F.lit(1)))
    grid = grid.select(sheet_col, activity_col,
                       *[F.col(str(d)).alias(str(d)) for d in days])
    if with_total:
        grid = grid.withColumn(TOTAL_LABEL, sum(F.coalesce(F.col(str(d)), F.lit(0)) for d in days))
    return grid
