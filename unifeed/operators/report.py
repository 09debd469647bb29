"""Summaries, roll-ups, counts and the presentation read model
(AGG1-AGG8, AGG10, WIN1, SRT1-SRT3, PRJ3, PRJ4, DUR5, NUM4, FLT5, JOI4)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, durations, numbers
from ..functions.numbers import round_half_even
from ..functions.text import blank_to_null, ws_trim

# Exact decimal used to sum hour values (they carry at most 4 decimals), so
# totals do not depend on the order partial sums are combined in.
HOURS_DECIMAL = T.DecimalType(20, 4)

# Presentation (BI) column names (PRJ3).
PRESENTATION_NAMES = {
    "date": "Date",
    "duration_hours": "Event Duration (Hours)",
    "event_name": "Event Name",
    "location": "Location of Event",
    "attendee_count": "Number of Police Department Attendees",
    "office": "Office",
}


def exact_sum(c) -> Column:
    """Order-independent sum of hour values (0 when every value is NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col.cast(HOURS_DECIMAL)), F.lit(0).cast(HOURS_DECIMAL)).cast("double")


def office_summary(feed: DataFrame, keys: Sequence[str] = ("office", "division")) -> DataFrame:
    """AGG1: per office x division -- events, attendee sum/mean, hour sum/mean.

    NULL group keys are dropped (as the reference's grouping does); sums of
    all-NULL groups are 0 and means NULL; results rounded half-even to 2.
    """
    f = feed
    for k in keys:
        f = f.where(F.col(k).isNotNull())
    return f.groupBy(*keys).agg(
        F.count("event_name").alias("n_events"),
        F.coalesce(F.sum("attendee_count"), F.lit(0)).cast("long").alias("total_attendees"),
        round_half_even(F.avg("attendee_count"), 2).alias("avg_attendees"),
        round_half_even(exact_sum("duration_hours"), 2).alias("total_hours"),
        round_half_even(F.try_divide(exact_sum("duration_hours"), F.count("duration_hours")), 2)
        .alias("avg_hours"),
    )


def bureau_rollup(feed: DataFrame) -> DataFrame:
    """AGG2: per office, event and location (case-insensitive, trimmed) -- summed
    hours and attendees; the location shown is the smallest spelling seen."""
    f = feed.where(F.col("office").isNotNull() & F.col("event_name").isNotNull()
                   & F.col("location").isNotNull())
    f = f.withColumn("_loc_key", F.lower(ws_trim(F.col("location"))))
    return f.groupBy("office", "event_name", "_loc_key").agg(
        F.min(ws_trim(F.col("location"))).alias("location"),
        round_half_even(exact_sum("duration_hours"), 2).alias("total_hours"),
        F.coalesce(F.sum("attendee_count"), F.lit(0)).cast("long").alias("total_attendees"),
        F.count(F.lit(1)).alias("n_events"),
    ).drop("_loc_key")


def value_share(df: DataFrame, key: str, scale: int = 2) -> DataFrame:
    """AGG3: value counts with percent of total (NULL keys are a group too).

    The total is a scalar subquery (computed once, no join of the groups).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(key, "n", numbers.pct(F.col("n"), total, scale).alias("pct"))


def _cube(df: DataFrame, row_key: str, col_key: str) -> DataFrame:
    """(_r, _c, margin, n): margin is 0 for a cell, 1 for a row's total over all columns, 2 for a
    column's total, 3 for the grand total.  NULL keys are groups of their own."""
    keyed = df.select(F.col(row_key).cast("string").alias("_r"), F.col(col_key).cast("string").alias("_c"))
    return keyed.cube("_r", "_c").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("margin"))


def _labelled(cells: DataFrame, row_key: str, col_key: str, all_label: str) -> DataFrame:
    over = lambda bit: F.col("margin").bitwiseAND(F.lit(bit)) != 0
    return cells.select(F.when(over(2), F.lit(all_label)).otherwise(F.col("_r")).alias(row_key),
                        F.when(over(1), F.lit(all_label)).otherwise(F.col("_c")).alias(col_key), "margin", "n")


def crosstab_margins(df: DataFrame, row_key: str, col_key: str, all_label: str = "All") -> DataFrame:
    """AGG4: counts of ``row_key x col_key`` with margins, long form (cells with no rows are absent).

    One ``cube`` pass.  ``margin`` (0 cell, 1 row total, 2 column total, 3 grand total) tells a margin
    from a value that happens to be called like ``all_label``; a NULL key stays NULL."""
    return _labelled(_cube(df, row_key, col_key), row_key, col_key, all_label)


def crosstab_full(df: DataFrame, row_key: str, col_key: str, all_label: str = "All") -> DataFrame:
    """AGG4 as a whole table: :func:`crosstab_margins` plus a zero cell for every pair of a row
    value and a column value that never meet.  Column values are one array (a crosstab's
    columns are few); each row value is expanded by it, so nothing is joined crosswise.  Cells
    are matched by key and margin, and margins are named last."""
    sparse = _cube(df, row_key, col_key)
    over = lambda bit: F.col("margin").bitwiseAND(F.lit(bit))
    rows = sparse.where(over(1) != 0).select("_r", over(2).alias("_m"))
    values = sparse.where(over(2) != 0).agg(F.collect_set(F.struct("_c", over(1).alias("m")))).scalar()
    cells = rows.select(F.col("_r").alias("_cr"), "_m", F.explode(values).alias("_v")).select(
        "_cr", F.col("_v._c").alias("_cc"), F.col("_m").bitwiseOR(F.col("_v.m")).alias("_cm"))
    on = (F.col("_cr").eqNullSafe(F.col("_r")) & F.col("_cc").eqNullSafe(F.col("_c")) & (F.col("_cm") == F.col("margin")))
    full = cells.join(sparse, on, "left").select(F.col("_cr").alias("_r"), F.col("_cc").alias("_c"), F.col("_cm").alias("margin"),
                                                 F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return _labelled(full, row_key, col_key, all_label)


def distinct_listing(df: DataFrame, key: str) -> DataFrame:
    """AGG6: every distinct value of a column with its rows, as a table (sorted on writing)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    """AGG6: distinct count of a column plus its min/max (a sorted distinct
    listing is ``df.select(key).distinct().orderBy(key)``, never collected)."""
    return df.agg(F.count_distinct(F.col(key)).alias("n_distinct"),
                  F.min(key).cast("string").alias("min_value"),
                  F.max(key).cast("string").alias("max_value"))


def date_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    """AGG5: min/max over parseable dates."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


QUANTILE_ACCURACY = 10_000   # rank error of the brackets: 1/accuracy of the rows


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``) of
    several columns at once: one row per column with ``column``, ``n`` and
    ``q0..qk`` -- without sorting a column or gathering it in one task.

    One scan brackets every wanted rank with ``percentile_approx`` (whose rank error is
    bounded); a second one counts the values below each bracket and the distinct values
    inside it, about 4/accuracy of the rows.  Ranks are prefix sums over those.  Columns with
    few values are bracketed by their minimum and maximum.  ``tiebreak`` is accepted for
    compatibility; equal values need none."""
    eps = 2.0 / QUANTILE_ACCURACY
    wanted = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-eps, eps)]
    val = lambda c: F.col(f"`{c}`").cast("double")
    brackets = []
    for c in cols:
        n, a = F.count(val(c)), F.percentile_approx(val(c), wanted, QUANTILE_ACCURACY)
        few = n <= F.lit(QUANTILE_ACCURACY)
        brackets.append(F.struct(F.lit(c).alias("_col"), n.alias("_n"), F.array(*[F.struct(
            F.when(few, F.min(val(c))).otherwise(a[2 * i]).alias("lo"),
            F.when(few, F.max(val(c))).otherwise(a[2 * i + 1]).alias("hi")) for i in range(len(probs))]).alias("_b")))
    bounds = df.agg(F.array(*brackets).alias("_all")).scalar()
    # per row and column: the wanted ranks whose bracket reaches the value or lies above it
    cells = df.select(F.explode(F.array(*[F.struct(
        F.lit(k).alias("k"), val(c).alias("v")) for k, c in enumerate(cols)])).alias("x")).select("x.k", "x.v")
    cells = cells.where(F.col("v").isNotNull()).withColumn("b", F.get(bounds, F.col("k")))
    near = cells.select("k", "v", F.posexplode("b._b").alias("i", "r")).where(F.col("v") <= F.col("r.hi"))
    # everything below a bracket is one entry, its values are entries of their own
    inside = F.when(F.col("v") >= F.col("r.lo"), F.col("v"))
    steps = near.groupBy("k", "i", inside.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = steps.withColumn("last", F.sum("c").over(
        Window.partitionBy("k", "i").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, 0)))
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probs]), F.col("i") + 1)
    upto = upto.withColumn("n", F.get(bounds, F.col("k"))["_n"]).withColumn("at", (F.col("n") - 1) * p)
    first = F.col("last") - F.col("c")
    picks = [F.max(F.when((first <= rank) & (rank < F.col("last")), F.col("v"))).alias(name)
             for rank, name in ((F.floor("at"), "lo"), (F.ceil("at"), "hi"))]
    each = upto.groupBy("k", "i").agg(*picks, F.max(F.col("at") - F.floor("at")).alias("fr"), F.max("n").alias("n"))
    out = each.groupBy("k").agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("i") == i, F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("fr"))).alias(f"q{i}")
        for i in range(len(probs))])
    names = F.array(*[F.lit(c) for c in cols])
    return out.select(F.get(names, F.col("k")).alias("column"), "n", *[f"q{i}" for i in range(len(probs))])


def describe_numeric(df: DataFrame, cols: Sequence[str], scale: int = 4,
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """AGG7: count, mean, sample std, min, exact quartiles, max per column; long form.

    Sums are exact decimals (inputs carry at most ``scale`` decimals), so mean
    and std do not depend on how partial sums are combined; quartiles are
    exact (linear interpolation, as pandas) and computed by
    :func:`exact_quantiles`, never in a single task.
    """
    dec = T.DecimalType(38, scale)
    sq = T.DecimalType(38, 2 * scale)
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x)
        s1 = F.sum(F.col(c).cast(dec)).cast("double")
        s2 = F.sum(F.col(c).cast(dec).cast(sq) * F.col(c).cast(dec).cast(sq)).cast("double")
        parts += [F.struct(F.lit(c).alias("column"), n.alias("count"), (s1 / n).alias("mean"),
                           F.when(n > 1, F.sqrt(F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0))))
                           .alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))]
    # every column's moments in ONE aggregation pass, then long form
    moments = df.agg(F.array(*parts).alias("_m")).select(F.explode("_m").alias("_m")).select("_m.*")
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75), tiebreak).select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return moments.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG8: key groups with more than one row (surfaced, not removed)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_row_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """AGG9: rows that repeat an earlier row on ``keys`` (NULL equals NULL);
    ``count(*) - number of distinct key tuples``."""
    keys = list(keys or df.columns)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"))


def attendance_stats(df: DataFrame) -> DataFrame:
    """AGG10: attendee sum, rows with names, rows with count 0 / >1, mean."""
    n = F.col("attendee_count")
    return df.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_attendees"),
        F.count_if(blank_to_null("attendee_names").isNotNull()).alias("rows_with_names"),
        F.count_if(n == 0).alias("rows_zero"),
        F.count_if(n > 1).alias("rows_multi"),
        round_half_even(F.avg(n), 4).alias("avg_attendees"),
        F.count(F.lit(1)).alias("rows"))


def first_n_per_group(df: DataFrame, group: str, order: Sequence[str], n: int = 2) -> DataFrame:
    """WIN1: the first ``n`` rows of every group under an explicit order.

    ``order`` must make the order total (end it with a unique row id).  A hot
    group is one window partition; the rank filter is pushed into the sort
    (``WindowGroupLimit``), so each task keeps only ``n`` rows per group.
    """
    w = Window.partitionBy(group).orderBy(*[F.col(o) for o in order])
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def presentation(feed: DataFrame, row_id: str | None = None) -> DataFrame:
    """§3.3 read model: typed casts (PRJ4), clamps (DUR5, NUM4), renames (PRJ3),
    NULL-date drop (FLT5).  Sorting (SRT1) is left to the sink."""
    d = dates.date_of(feed, "date")
    whole = isinstance(feed.schema["attendee_count"].dataType, T.IntegralType)
    out = feed.select(
        d.alias("Date"),
        durations.clamp_presentation_hours(F.col("duration_hours").cast("double"))
        .alias(PRESENTATION_NAMES["duration_hours"]),
        F.col("event_name").alias(PRESENTATION_NAMES["event_name"]),
        F.col("location").alias(PRESENTATION_NAMES["location"]),
        numbers.clamp_presentation_count(F.col("attendee_count"), numeric=whole)
        .alias(PRESENTATION_NAMES["attendee_count"]),
        F.col("office").alias(PRESENTATION_NAMES["office"]),
        *([F.col(row_id)] if row_id else []),
    )
    return out.where(F.col("Date").isNotNull())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT3: the first ``n`` rows for a look (the limit is the feature)."""
    return df.limit(n)


def sorted_for_sink(df: DataFrame, *cols: str) -> DataFrame:
    """SRT1: global sort at the sink only (range-partitioned, no single task)."""
    return df.orderBy(*cols)


def run_delta(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JOI4: per-key row counts of two runs, full outer joined, zero-filled, with delta."""
    k = list(keys)
    b = before.groupBy(*k).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(*k).agg(F.count(F.lit(1)).alias("rows_after"))
    j = b.join(a, [b[c].eqNullSafe(a[c]) for c in k], "full_outer")
    return j.select(*[F.coalesce(b[c], a[c]).alias(c) for c in k],
                    F.coalesce(F.col("rows_before"), F.lit(0)).alias("rows_before"),
                    F.coalesce(F.col("rows_after"), F.lit(0)).alias("rows_after")) \
        .withColumn("delta", F.col("rows_after") - F.col("rows_before"))


def change_set(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JOI4 by row: the multiset difference of two runs, one row per distinct row that differs.

    Columns: ``keys``, ``row`` (the whole row as JSON, NULLs included), ``n_before``, ``n_after``,
    ``delta`` and ``change``: ``changed`` where rows of the same key differ on both sides (the old
    rows have a negative delta, the new ones a positive), else ``inserted`` or ``removed``.
    Repeated rows count; NULL keys are values.  Columns that only one run has are NULL in the
    other.

    Two aggregations: rows are counted by content first (repeats collapse map-side), then only
    what differs is summed by key, so a key that holds a third of all rows costs no more."""
    cols = [*before.columns, *[c for c in after.columns if c not in before.columns]]

    def side(df: DataFrame, n_before: int, n_after: int) -> DataFrame:
        have = [F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in cols]
        whole = F.to_json(F.struct(*have), {"ignoreNullFields": "false"})
        return df.select(*[F.col(f"`{k}`") for k in keys], whole.alias("row"),
                         F.lit(n_before).alias("_b"), F.lit(n_after).alias("_a"))
    k = [F.col(f"`{x}`") for x in keys]
    counted = (side(before, 1, 0).unionByName(side(after, 0, 1)).groupBy(*k, "row")
               .agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after"))
               .withColumn("delta", F.col("n_after") - F.col("n_before")).where(F.col("delta") != 0))
    both = counted.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(k)]).agg(
        ((F.min("delta") < 0) & (F.max("delta") > 0)).alias("_both"))
    on = [c.eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(k)]
    change = (F.when(F.col("_both"), "changed").when(F.col("delta") > 0, "inserted").otherwise("removed"))
    return counted.join(both, on).select(*k, "row", "n_before", "n_after", "delta", change.alias("change"))


def change_counts(changes: DataFrame) -> DataFrame:
    """JOI4: one row of totals over a :func:`change_set`: rows inserted, removed, and changed (new
    rows of keys that differ on both sides), and the change in the number of rows."""
    n = lambda cond, v: F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("long")
    d, what = F.col("delta"), F.col("change")
    return changes.agg(n(what == "inserted", d).alias("inserted"), n(what == "removed", -d).alias("removed"),
                       n((what == "changed") & (d > 0), d).alias("changed"),
                       F.coalesce(F.sum(d), F.lit(0)).cast("long").alias("rows_delta"))
