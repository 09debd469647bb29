"""Per-source recipes that map a raw log to the canonical event feed.

Each recipe is a chain of projections over the raw frame (PRJ1 mapping, the
repair expressions, PRJ2 literals).  Filters on parsed values stay above the
parsing, so a cell is parsed once.  Mappings are data: pass your own for other sheet layouts.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, durations, numbers, people, places
from ..functions.text import blank_to_null, missing_to_null
from ..sources.files import keep_above
from .schema import header_lookup, to_canonical

# Header -> canonical mappings of the three hand-kept logs.
COMMUNITY_MAPPING = {
    "Community Event": "event_name",
    "Date of Event": "date",
    "Start Time": "start_time",
    "End Time": "end_time",
    "Event Location": "location",
    "Event Duration9": "given_duration",
    "Member Count": "given_count",
}
COMMUNITY_MEMBER_COLUMNS = tuple([f"Participating Member {i}" for i in range(1, 10)]
                                 + ["Participating Memb 10"])
STACP_MAPPING = {
    "School Outreach Conducted ": "event_name",
    "Date": "date",
    "Start Time": "start_time",
    "End Time": "end_time",
    "Location": "location",
    "Total Time": "given_duration",
}
STACP_EXTRA_ATTENDEES = ("Attendees2", "Attendees3", "Attendees4", "Attendees5")
PATROL_MAPPING = {
    "Event Type": "event_name",
    "Date": "date",
    "Start Time": "start_time",
    "End Time": "end_time",
    "Event Location": "location",
}
# The dispatch export columns the recipe reads (SRC5).
DISPATCH_COLUMNS = ("ReportNumberNew", "Time of Call", "Time Out Display", "Time In Display",
                    "Incident", "SelfJoinCADNumber::Business Name", "St Number", "StreetName",
                    "Officer", "Squad", "DispatcherNew")


def _present(df: DataFrame, name: str):
    actual = header_lookup(df).get(name.rstrip())
    return F.col(f"`{actual}`") if actual is not None else F.lit(None).cast("string")


def _clock_text(seconds):
    return durations.hhmm(seconds)


def _select_mapped(raw: DataFrame, mapping: Mapping[str, str], extra: Sequence = ()) -> DataFrame:
    """Stage 1: raw cells renamed to canonical names (absent headers -> NULL)."""
    look = header_lookup(raw)
    sel = [F.col(f"`{look[s.rstrip()]}`").alias(d) if s.rstrip() in look
           else F.lit(None).cast("string").alias(d) for s, d in mapping.items()]
    have = {d for d in mapping.values()}
    for need in ("date", "start_time", "end_time", "event_name", "location", "given_duration"):
        if need not in have:
            sel.append(F.lit(None).cast("string").alias(need))
    return raw.select(*sel, *extra)


def _normalized(df: DataFrame, passthrough: Sequence[str]) -> DataFrame:
    """Stage 2: normalised text once per cell (trim, blanks and ``nan`` -> NULL)."""
    return df.select(
        missing_to_null("date").alias("t_date"),
        missing_to_null("start_time").alias("t_start"),
        missing_to_null("end_time").alias("t_end"),
        durations.duration_text("given_duration").alias("t_dur"),
        blank_to_null("event_name").alias("event_name"),
        blank_to_null("location").alias("location"),
        *passthrough)


def _parsed(df: DataFrame, passthrough: Sequence[str]) -> DataFrame:
    """Stages 3-4: prepared parse inputs (each regex once per cell), then typed values, which
    filters read and do not parse again."""
    names = [p if isinstance(p, str) else None for p in passthrough]
    prep = df.select(
        dates.date_iso("t_date", normalized=True).alias("_iso"),
        durations.clock_digits("t_start", normalized=True).alias("_sd"),
        durations.clock_digits("t_end", normalized=True).alias("_ed"),
        durations.duration_hours("t_dur", normalized=True, positive_only=False).alias("given_raw"),
        "event_name", "location", *passthrough)
    keep = [n for n in names if n is not None] + [c for c in prep.columns
                                                  if c not in ("_iso", "_sd", "_ed", "given_raw",
                                                               "event_name", "location") and c not in names]
    return keep_above(prep.select(
        dates.date_from_iso("_iso").alias("date"),
        durations.clock_from_digits("_sd").alias("start_s"),
        durations.clock_from_digits("_ed").alias("end_s"),
        F.when(F.col("given_raw") > 0, F.col("given_raw")).alias("given_hours"),
        "event_name", "location", *keep))


def community_log(raw: DataFrame, data_source: str = "outreach_log",
                  processed_date: _dt.date | None = None,
                  office: str = "Community Engagement", division: str = "Outreach",
                  mapping: Mapping[str, str] = COMMUNITY_MAPPING,
                  member_columns: Sequence[str] = COMMUNITY_MEMBER_COLUMNS,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Manual log A -> canonical (DUR1-DUR3, NUM1, STR13, DAT1/DAT2).

    Head count: the given count column when the sheet has one (NUM1), else
    the ``[,/&]`` split summed over member columns (STR13).  Duration: given
    -> elapsed (midnight wrap) -> 0.5.
    """
    look = header_lookup(raw)
    has_count = any(src.rstrip() in look for src, dst in mapping.items() if dst == "given_count")
    members = [c for c in member_columns if c.rstrip() in look]
    if has_count:
        src = next(k for k, v in mapping.items() if v == "given_count")
        count = numbers.given_head_count(_present(raw, src))
    elif members:
        count = people.simple_count(*[_present(raw, c) for c in members])
    else:
        count = F.lit(0).cast("long")
    keep_cols = [F.col(f"`{k}`") for k in keep]
    s1 = _select_mapped(raw, {k: v for k, v in mapping.items() if v != "given_count"},
                        [count.alias("attendee_count"), *keep_cols])
    s2 = _normalized(s1, ["attendee_count", *keep])
    s3 = _parsed(s2, ["attendee_count", *keep])
    out = s3.select(
        "date",
        _clock_text(F.col("start_s")).alias("start_time"),
        _clock_text(F.col("end_s")).alias("end_time"),
        "event_name", "location",
        durations.pick_duration("given_hours", durations.elapsed_hours("start_s", "end_s"))
        .alias("duration_hours"),
        "attendee_count",
        F.lit(office).alias("office"),
        F.lit(division).alias("division"),
        F.lit("").alias("attendee_names"),
        F.lit(data_source).alias("data_source"),
        F.lit(processed_date).cast("date").alias("processed_date"),
        *keep,
    )
    return to_canonical(out, keep_extras=bool(keep))


def stacp_log(raw: DataFrame, data_source: str = "stacp",
              processed_date: _dt.date | None = None,
              office: str = "STA&CP", division: str = "STACP",
              mapping: Mapping[str, str] = STACP_MAPPING,
              primary: str = "Attendees", extras: Sequence[str] = STACP_EXTRA_ATTENDEES,
              free_text: str = "Free Type Attendees",
              aliases: Mapping[str, str] | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """Manual log B -> canonical (DUR1 incl. ``N Hrs. M Mins``, DUR3, STR14 roster, JOI3).

    ``aliases`` is a small constant dict inlined as a map lookup; for an
    alias *table* use :func:`unifeed.operators.combine.apply_alias_table`.
    """
    roster = people.roster_names(_present(raw, primary), [_present(raw, e) for e in extras],
                                 _present(raw, free_text))
    keep_cols = [F.col(f"`{k}`") for k in keep]
    s1 = _select_mapped(raw, mapping, [roster.alias("names"), *keep_cols])
    s2 = _normalized(s1, ["names", *keep])
    s3 = _parsed(s2, ["names", *keep])
    # aliases replace names one by one, so the count does not need them
    names = F.transform("names", lambda n: people.alias_map_lookup(n, aliases)) if aliases else F.col("names")
    out = s3.select(
        "date",
        _clock_text(F.col("start_s")).alias("start_time"),
        _clock_text(F.col("end_s")).alias("end_time"),
        "event_name", "location",
        durations.pick_duration("given_hours", durations.elapsed_hours("start_s", "end_s"))
        .alias("duration_hours"),
        F.size("names").cast("long").alias("attendee_count"),
        F.lit(office).alias("office"),
        F.lit(division).alias("division"),
        F.array_join(names, ", ").alias("attendee_names"),
        F.lit(data_source).alias("data_source"),
        F.lit(processed_date).cast("date").alias("processed_date"),
        *keep,
    )
    return to_canonical(out, keep_extras=bool(keep))


def patrol_log(raw: DataFrame, data_source: str = "patrol",
               processed_date: _dt.date | None = None,
               office: str = "Patrol", division: str = "Patrol",
               mapping: Mapping[str, str] = PATROL_MAPPING,
               people_columns: Sequence[str] = ("Patrol Members Assigned",),
               keep: Sequence[str] = ()) -> DataFrame:
    """Manual log C -> canonical (STR10-STR12, NUM3; elapsed duration, no default)."""
    keep_cols = [F.col(f"`{k}`") for k in keep]
    pcols = [f"_p{i}" for i in range(len(people_columns))]
    s1 = _select_mapped(raw, mapping, [*[_present(raw, p).alias(n) for p, n in zip(people_columns, pcols)],
                                       *keep_cols])
    s2 = _normalized(s1, [*pcols, *keep])
    fields = [people.patrol_field(c).alias(f"_f{i}") for i, c in enumerate(pcols)]
    s3 = _parsed(s2, [*fields, *keep])
    names = (F.concat(*[F.col(f"_f{i}.names") for i in range(len(pcols))]) if len(pcols) > 1
             else F.col("_f0.names"))
    n = F.col("_f0.n")
    for i in range(1, len(pcols)):
        n = n + F.col(f"_f{i}.n")
    has_all = F.col("date").isNotNull() & F.col("event_name").isNotNull() & F.col("location").isNotNull()
    out = s3.select(
        "date",
        _clock_text(F.col("start_s")).alias("start_time"),
        _clock_text(F.col("end_s")).alias("end_time"),
        "event_name", "location",
        durations.pick_duration(F.lit(None).cast("double"), durations.elapsed_hours("start_s", "end_s"),
                                default=None).alias("duration_hours"),
        F.when((n == 0) & has_all, F.lit(1).cast("long")).otherwise(n).alias("attendee_count"),
        F.lit(office).alias("office"),
        F.lit(division).alias("division"),
        F.array_join(names, ", ").alias("attendee_names"),
        F.lit(data_source).alias("data_source"),
        F.lit(processed_date).cast("date").alias("processed_date"),
        *keep,
    )
    return to_canonical(out, keep_extras=bool(keep))


def dispatch_export(raw: DataFrame, routes: DataFrame, data_source: str = "cad_ce",
                    processed_date: _dt.date | None = None,
                    keep: Sequence[str] = (), on_inversion: str = "impute") -> DataFrame:
    """Dispatch export -> routed rows with ``include``, ``imputed`` flags (NUM5, DUR4,
    STR7, TIM1/TIM2).  The route table is a fixed, tiny lookup: broadcast it.

    Returns every input row; callers split on ``include`` (FLT2/OUT2/OUT4).  ``on_inversion``: what
    becomes of a call that ends before it begins (:func:`durations.memorial_guard`).
    """
    look = header_lookup(raw)
    g = lambda n: _present(raw, n)
    keep_cols = [F.col(f"`{k}`") for k in keep if k in look or k in raw.columns]
    kept = [k for k in keep if k in look or k in raw.columns]
    s1 = raw.select(
        places.case_number(g("ReportNumberNew")).alias("case_no"),
        missing_to_null(g("Time of Call")).alias("t_call"),
        missing_to_null(g("Time Out Display")).alias("t_out"),
        missing_to_null(g("Time In Display")).alias("t_in"),
        blank_to_null(g("Incident")).alias("event_name"),
        places.compose_location(g("SelfJoinCADNumber::Business Name"), g("St Number"),
                                g("StreetName")).alias("location"),
        blank_to_null(g("Squad")).alias("squad"),
        F.coalesce(blank_to_null(g("Officer")), F.lit("")).alias("attendee_names"),
        *keep_cols)
    s15 = s1.select(
        "case_no", dates.date_iso("t_call", normalized=True).alias("_iso"),
        durations.clock_digits("t_out", normalized=True).alias("_od"),
        durations.clock_digits("t_in", normalized=True).alias("_id"),
        "event_name", "location", "squad", "attendee_names", *kept)
    s2 = keep_above(s15.select(
        "case_no", dates.date_from_iso("_iso").alias("date"),
        durations.clock_from_digits("_od").alias("out_s"),
        durations.clock_from_digits("_id").alias("in_s"),
        "event_name", "location", "squad", "attendee_names", *kept))
    dur, imputed, end_s = durations.memorial_guard("out_s", "in_s", on_inversion)
    base = s2.select(
        "case_no", "date",
        durations.hhmm(F.col("out_s")).alias("start_time"),
        durations.hhmm(end_s).alias("end_time"),
        "event_name", "location",
        dur.alias("duration_hours"),
        imputed.alias("imputed"),
        F.lit(1).cast("long").alias("attendee_count"),
        "squad", "attendee_names", *kept)
    r = F.broadcast(routes)
    joined = base.join(r, base["squad"].eqNullSafe(r["squad"]), "left").drop(r["squad"])
    return joined.select(
        "*",
        F.coalesce(F.col("include"), F.lit(True)).alias("_include"),
        F.coalesce(F.col("route_office"), F.col("squad"), F.lit("")).alias("office"),
        F.coalesce(F.col("route_division"), F.lit("")).alias("division"),
        F.lit(data_source).alias("data_source"),
        F.lit(processed_date).cast("date").alias("processed_date"),
    ).drop("include", "route_office", "route_division").withColumnRenamed("_include", "include")
