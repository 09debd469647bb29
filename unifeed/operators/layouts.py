"""Ambiguous date layouts settled by their file (DAT1).

``03/04/25`` is the 3rd of April in one file and the 4th of March in another.  Cells that can
only be read one way (a part above 12) vote for their (file, column); counts are one grouped
pass, and the small table of votes goes back to the rows.  A file without a majority is
listed, and its ambiguous cells stay NULL instead of being guessed.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import missing_to_null

SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})( .*)?$"
DAY_FIRST, MONTH_FIRST, TIED = "day first", "month first", "tied"


def _parts(text: Column) -> tuple[Column, Column]:
    """The first two numbers of a slashed date (NULL for any other text)."""
    part = lambda i: F.regexp_extract(text, SLASHED, i).try_cast("int")
    return part(1), part(2)


def layout_votes(df: DataFrame, group: Sequence[str], date_cols: Sequence[str]) -> DataFrame:
    """(group columns, column, day_first, month_first, ambiguous, layout): one row per group and date
    column; the layout with more votes, or ``tied``."""
    aggs = []
    for i, c in enumerate(date_cols):
        a, b = _parts(missing_to_null(F.col(f"`{c}`").cast("string")))
        aggs += [F.count_if((a > 12) & (b <= 12)).alias(f"_d{i}"), F.count_if((a <= 12) & (b > 12)).alias(f"_m{i}"),
                 F.count_if((a <= 12) & (b <= 12) & (a != b)).alias(f"_a{i}")]
    one = df.groupBy(*[F.col(f"`{g}`") for g in group]).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("day_first"), F.col(f"_m{i}").alias("month_first"),
                     F.col(f"_a{i}").alias("ambiguous")) for i, c in enumerate(date_cols)]
    out = one.select(*[F.col(f"`{g}`") for g in group], F.explode(F.array(*rows)).alias("v")).select(*[F.col(f"`{g}`") for g in group], "v.*")
    d, m = F.col("day_first"), F.col("month_first")
    return out.withColumn("layout", F.when(d > m, DAY_FIRST).when(m > d, MONTH_FIRST).otherwise(TIED))


def parse_by_layout(df: DataFrame, group: Sequence[str], date_col: str, votes: DataFrame | None = None,
                    name: str = "parsed_date") -> DataFrame:
    """``df`` with ``name``: the date of ``date_col``, slashed dates read as their group's layout (or the
    only way they can be), all other texts as :func:`~unifeed.functions.dates.parse_date` does;
    and ``layout``.  Ambiguous cells of a tied group are NULL."""
    votes = layout_votes(df, group, [date_col]) if votes is None else votes
    side = votes.where(F.col("column") == date_col).select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)],
                                                           F.col("layout").alias("_layout"))
    on = [F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    text = missing_to_null(F.col(f"`{date_col}`").cast("string"))
    a, b = _parts(text)
    swapped = F.regexp_replace(text, SLASHED, "$2/$1/$3$4")
    read = (F.when(a.isNull() | (b > 12) | (a == b), text).when(a > 12, swapped)
            .when(F.col("_layout") == DAY_FIRST, swapped).when(F.col("_layout") == MONTH_FIRST, text))
    joined = df.join(side, on, "left").withColumn("_text", read)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], dates.parse_date("_text", normalized=True).alias(name),
                         F.col("_layout").alias("layout"))
