"""Feed-level queries: the canonical union, filters, gap-fill, summaries,
presentation (PRJ1-PRJ4, REL1, FLT1, FLT5, JOI1, JOI4, AGG1, AGG2, DUR5, NUM4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import report
from ..operators.schema import CANONICAL_COLUMNS
from . import oracle_sql as S
from .catalog import register
from .feed import build_feed

_F = S.feed_ctes()
_CANON = S.CANON


@register("feed_office_summary", f"""{_F}
SELECT office, division, count(event_name) AS n_events,
  CAST(coalesce(sum(attendee_count), 0) AS BIGINT) AS total_attendees,
  round_even(avg(attendee_count), 2) AS avg_attendees,
  round_even({S.exact_sum('duration_hours')}, 2) AS total_hours,
  round_even(CASE WHEN count(duration_hours) > 0 THEN {S.exact_sum('duration_hours')} / count(duration_hours) END, 2)
    AS avg_hours
FROM feed WHERE office IS NOT NULL AND division IS NOT NULL GROUP BY office, division""")
def feed_office_summary(spark, sf_dir):
    """Flagship. §3.1 end to end: 4 sources -> union -> FLT1 -> JOI1 -> AGG1."""
    return report.office_summary(build_feed(spark, sf_dir).feed)


@register("standardize_union", f"""{_F}
SELECT {_CANON} FROM unioned""")
def standardize_union(spark, sf_dir):
    """PRJ1 PRJ2 PRJ5 REL1: every source mapped to the canonical schema and unioned."""
    from ..operators.schema import union_sources
    from .feed import driver_sources
    return union_sources(driver_sources(spark, sf_dir).values()).select(*CANONICAL_COLUMNS)


@register("contamination_filter", f"""{_F}
SELECT data_source, count(*) AS n_kept FROM kept GROUP BY data_source""")
def contamination_filter(spark, sf_dir):
    """FLT1 kept side, counted per source."""
    from ..operators.combine import remove_contamination
    from ..operators.schema import union_sources
    from .feed import driver_sources
    kept, _ = remove_contamination(union_sources(driver_sources(spark, sf_dir).values()))
    return kept.groupBy("data_source").agg(F.count(F.lit(1)).alias("n_kept"))


@register("contamination_audit", f"""{_F}
SELECT {_CANON} FROM removed""")
def contamination_audit(spark, sf_dir):
    """FLT1 removed side: the audit listing."""
    return build_feed(spark, sf_dir).removed.select(*CANONICAL_COLUMNS)


@register("gapfill_feed_dropped", f"""{_F}
SELECT {_CANON} FROM gap_dropped""")
def gapfill_feed_dropped(spark, sf_dir):
    """JOI1 audit: dispatch rows dropped because a manual log covers (date, place)."""
    return build_feed(spark, sf_dir).gap_dropped.select(*CANONICAL_COLUMNS)


@register("canonical_feed", f"""{_F}
SELECT {_CANON} FROM feed""")
def canonical_feed(spark, sf_dir):
    """§3.1 output: the combined, filtered, gap-filled feed (SNK1 content)."""
    return build_feed(spark, sf_dir).feed.select(*CANONICAL_COLUMNS)


@register("bureau_rollup", f"""{_F}
SELECT office, event_name, min({S.trim_ws('location')}) AS location,
  round_even({S.exact_sum('duration_hours')}, 2) AS total_hours,
  CAST(coalesce(sum(attendee_count), 0) AS BIGINT) AS total_attendees, count(*) AS n_events
FROM feed WHERE office IS NOT NULL AND event_name IS NOT NULL AND location IS NOT NULL
GROUP BY office, event_name, lower({S.trim_ws('location')})""")
def bureau_rollup(spark, sf_dir):
    """AGG2: roll-up by office, event and case-folded location."""
    return report.bureau_rollup(build_feed(spark, sf_dir).feed)


@register("present_feed", f"""{_F}
SELECT date AS "Date",
  CASE WHEN duration_hours IS NULL OR duration_hours <= 0 THEN 0.5 WHEN duration_hours > 24 THEN 8.0
       ELSE round_even(duration_hours, 2) END AS "Event Duration (Hours)",
  event_name AS "Event Name", location AS "Location of Event",
  CASE WHEN attendee_count IS NULL OR attendee_count <= 0 THEN 1 ELSE attendee_count END
    AS "Number of Police Department Attendees",
  office AS "Office"
FROM feed WHERE date IS NOT NULL""")
def present_feed(spark, sf_dir):
    """§3.3 PRJ3 PRJ4 DUR5 NUM4 FLT5: the presentation table (sorted only at the sink)."""
    return report.presentation(build_feed(spark, sf_dir).feed)


@register("run_delta", f"""{_F},
before AS (SELECT data_source, office, count(*) AS n FROM keyed GROUP BY ALL),
after AS (SELECT data_source, office, count(*) AS n FROM feed GROUP BY ALL)
SELECT coalesce(b.data_source, a.data_source) AS data_source, coalesce(b.office, a.office) AS office,
  coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) AS rows_after,
  coalesce(a.n, 0) - coalesce(b.n, 0) AS delta
FROM before b FULL OUTER JOIN after a
  ON b.data_source IS NOT DISTINCT FROM a.data_source AND b.office IS NOT DISTINCT FROM a.office""")
def run_delta(spark, sf_dir):
    """JOI4: rows per (source, office) without vs with the gap-fill step."""
    without = build_feed(spark, sf_dir, gap_fill_enabled=False).feed
    with_ = build_feed(spark, sf_dir).feed
    return report.run_delta(without, with_, ["data_source", "office"])


@register("attendance_stats", f"""{_F}
SELECT CAST(coalesce(sum(attendee_count), 0) AS BIGINT) AS total_attendees,
  count_if(NULLIF({S.trim_ws('attendee_names')}, '') IS NOT NULL) AS rows_with_names,
  count_if(attendee_count = 0) AS rows_zero, count_if(attendee_count > 1) AS rows_multi,
  round_even(avg(attendee_count), 4) AS avg_attendees, count(*) AS rows
FROM feed""")
def attendance_stats(spark, sf_dir):
    """AGG10 over the feed."""
    return report.attendance_stats(build_feed(spark, sf_dir).feed)


@register("feed_date_range", f"""{_F}
SELECT data_source, min(date) AS first_date, max(date) AS last_date FROM feed GROUP BY data_source""")
def feed_date_range(spark, sf_dir):
    """AGG5 per source."""
    feed = build_feed(spark, sf_dir).feed
    return feed.groupBy("data_source").agg(F.min("date").alias("first_date"),
                                           F.max("date").alias("last_date"))
