"""ANSI/DuckDB SQL twins of the engine's expressions, used as the correctness
oracle.  Each builder takes column *names* (never nested expressions) so the
generated SQL grows linearly; multi-step recipes are written as layered CTEs.

The raw-source derivations repeat :mod:`unifeed.plans.driver_tables` with the
same arithmetic.
"""

from __future__ import annotations

from ..functions import durations as _d
from ..functions import people as _p
from ..functions import places as _pl
from ..functions.text import NUMBER_PATTERN
from ..functions.numbers import ROUTE_ROWS
from ..operators.combine import CONTAMINATION_OFFICES, CONTAMINATION_REGEX
from . import driver_tables as _dt

CLOCK = _d.CLOCK_PATTERN
DAYS = r"^(\d+)\s*days?\s+(\d+):(\d{1,2})(:(\d{1,2}))?$"
HMS = r"^(\d+):(\d{1,2})(:(\d{1,2}))?$"
WORDS = r"^(\d+(\.\d+)?)\s*(h|hr|hrs|hour|hours)\.?(\s*(\d+)\s*(m|min|mins|minute|minutes)\.?)?$"
ISO = r"^(\d{4})-(\d{1,2})-(\d{1,2})([ T].*)?$"
US4 = r"^(\d{1,2})/(\d{1,2})/(\d{4})( .*)?$"
US2 = r"^(\d{1,2})/(\d{1,2})/(\d{2})( .*)?$"
YMD = r"^(\d{4})/(\d{1,2})/(\d{1,2})( .*)?$"
NAMED = r"^([A-Za-z]{3})[a-z]{0,6}\.? (\d{1,2}),? (\d{4})( .*)?$"
AMPM = r"^(0?[1-9]|1[0-2]):([0-5]\d)(:([0-5]\d))? ?([AaPp])\.?[Mm]\.?$"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def trim_ws(x: str) -> str:
    return f"trim({x}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


def b2n(x: str) -> str:
    return f"NULLIF({trim_ws(f'CAST({x} AS VARCHAR)')}, '')"


def m2n(x: str) -> str:
    b = b2n(x)
    return f"CASE WHEN lower({b}) IN ('nan', 'none', 'nat', 'null') THEN NULL ELSE {b} END"


def to_double(x: str) -> str:
    t = trim_ws(f"CAST({x} AS VARCHAR)")
    return f"CASE WHEN regexp_matches({t}, {q(NUMBER_PATTERN)}) THEN TRY_CAST({t} AS DOUBLE) END"


def to_long_trunc(x: str) -> str:
    return f"TRY_CAST(trunc({to_double(x)}) AS BIGINT)"


def rx(t: str, pat: str, i: int, typ: str = "DOUBLE") -> str:
    return f"TRY_CAST(regexp_extract({t}, {q(pat)}, {i}) AS {typ})"


def parse_date(t: str) -> str:
    """DAT1 on an already-normalised text column ``t`` (see :func:`m2n`)."""
    iso = t
    for pat, rep in ((ISO, r"\1-\2-\3"), (US4, r"\3-\1-\2"), (US2, r"20\3-\1-\2"), (YMD, r"\1-\2-\3")):
        iso = f"regexp_replace({iso}, {q(pat)}, {q(rep)})"
    month = (f"list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], "
             f"lower(regexp_extract({t}, {q(NAMED)}, 1)))")
    iso = (f"CASE WHEN regexp_matches({t}, {q(NAMED)}) AND {month} IS NOT NULL THEN regexp_extract({t}, {q(NAMED)}, 3) || '-' || "
           f"{month} || '-' || regexp_extract({t}, {q(NAMED)}, 2) ELSE {iso} END")
    return f"CASE WHEN regexp_matches({iso}, {q(r'^\d{4}-\d{1,2}-\d{1,2}$')}) THEN TRY_CAST({iso} AS DATE) END"


def clock_seconds(t: str) -> str:
    h, m = rx(t, CLOCK, 1, "INTEGER"), rx(t, CLOCK, 2, "INTEGER")
    s = f"coalesce({rx(t, CLOCK, 4, 'INTEGER')}, 0)"
    ah, am = rx(t, AMPM, 1, "INTEGER"), rx(t, AMPM, 2, "INTEGER")
    as_ = f"coalesce({rx(t, AMPM, 4, 'INTEGER')}, 0)"
    late = f"CASE WHEN lower(regexp_extract({t}, {q(AMPM)}, 5)) = 'p' THEN 43200 ELSE 0 END"
    return (f"CASE WHEN regexp_matches({t}, {q(CLOCK)}) AND {h} < 24 AND {m} < 60 AND {s} < 60 "
            f"THEN {h} * 3600 + {m} * 60 + {s} "
            f"WHEN regexp_matches({t}, {q(AMPM)}) THEN ({ah} % 12) * 3600 + {am} * 60 + {as_} + {late} "
            f"WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}[ T]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$') "
            f"THEN {rx(t, '[ T]([0-9]+):', 1, 'INTEGER')} * 3600 + {rx(t, '[ T][0-9]+:([0-9]+)', 1, 'INTEGER')} * 60 "
            f"+ coalesce({rx(t, '[ T][0-9]+:[0-9]+:([0-9]+)', 1, 'INTEGER')}, 0) "
            f"WHEN regexp_matches({t}, '^0?[.][0-9]+$') THEN CAST(round(TRY_CAST({t} AS DOUBLE) * 86400) AS INTEGER) % 86400 END")


def duration_hours(t: str) -> str:
    """DUR1 on a lower-cased normalised text column ``t``."""
    g = lambda p, i: rx(t, p, i)
    g0 = lambda p, i: f"coalesce({rx(t, p, i)}, 0.0)"
    hours = (f"CASE WHEN regexp_matches({t}, {q(NUMBER_PATTERN)}) THEN TRY_CAST({t} AS DOUBLE) "
             f"WHEN regexp_matches({t}, {q(DAYS)}) THEN {g(DAYS, 1)} * 24.0 + {g(DAYS, 2)} "
             f"+ {g(DAYS, 3)} / 60.0 + {g0(DAYS, 5)} / 3600.0 "
             f"WHEN regexp_matches({t}, {q(HMS)}) THEN {g(HMS, 1)} + {g(HMS, 2)} / 60.0 "
             f"+ {g0(HMS, 4)} / 3600.0 "
             f"WHEN regexp_matches({t}, {q(WORDS)}) THEN {g(WORDS, 1)} + {g0(WORDS, 5)} / 60.0 END")
    return hours


def positive(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} END"


def elapsed(start_s: str, end_s: str) -> str:
    d = f"({end_s} - {start_s})"
    return f"(CASE WHEN {d} < 0 THEN {d} + 86400 ELSE {d} END) / 3600.0"


def hhmm(s: str) -> str:
    return (f"CASE WHEN {s} IS NOT NULL THEN printf('%02d:%02d', CAST(floor({s} / 3600) AS BIGINT), "
            f"CAST(floor(({s} % 3600) / 60) AS BIGINT)) END")


def hms(s: str) -> str:
    return (f"printf('%02d:%02d:%02d', CAST(floor({s} / 3600) AS BIGINT), "
            f"CAST(floor(({s} % 3600) / 60) AS BIGINT), CAST({s} % 60 AS BIGINT))")


def normalize_name(x: str) -> str:
    inner = trim_ws(f"regexp_replace({trim_ws(x)}, {q(_p.RANK_PREFIX)}, '')")
    return rf"regexp_replace({inner}, '^([A-Za-z])\.(\S)', '\1. \2')"


def split_people(t: str) -> str:
    return (f"list_filter(list_transform(string_split_regex({trim_ws(t)}, {q(_p.PEOPLE_SPLIT)}), "
            f"lambda x: {normalize_name('x')}), lambda x: x <> '')")


def location_key(x: str) -> str:
    return f"regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), '[^a-z0-9]', '', 'g')"


def location_tokens(x: str) -> str:
    t = f"regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), '[^a-z0-9 ]', ' ', 'g')"
    stop = ", ".join(q(w) for w in _pl.LOCATION_STOPWORDS)
    return (f"list_sort(list_distinct(list_filter(string_split({t}, ' '), "
            f"lambda x: x <> '' AND x NOT IN ({stop}))))")


def case_when_mod(key: str, mod: int, *values: str) -> str:
    parts = " ".join(f"WHEN {key} % {mod} = {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {parts} END"


def contamination(office: str = "office", event: str = "event_name") -> str:
    offs = ", ".join(q(o) for o in CONTAMINATION_OFFICES)
    return (f"(coalesce(lower({trim_ws(office)}) IN ({offs}), false) OR "
            f"coalesce(regexp_matches({event}, {q(CONTAMINATION_REGEX)}), false))")


# ---------------------------------------------------------------- raw sources

def community_raw_sql() -> str:
    k, c = "o_orderkey", "o_custkey"
    site = f"('Site ' || CAST({c} % 50 AS VARCHAR))"
    return f"""SELECT {k} AS row_id,
  strftime(o_orderdate, '%m/%d/%Y') AS "Date of Event",
  CASE WHEN {k} % 9 <> 0 THEN printf('%02d:%02d', 8 + {k} % 10, ({k} % 4) * 15) END AS "Start Time",
  CASE WHEN {k} % 13 <> 0 THEN printf('%02d:%02d', (14 + {k} % 10 + {c} % 3) % 24, ({c} % 4) * 15) END AS "End Time",
  CASE WHEN {k} % 17 = 0 THEN 'Arrests' WHEN {k} % 19 = 0 THEN 'Patrol (Monthly Total)' ELSE o_orderpriority END AS "Community Event",
  {case_when_mod(c, 3, f"upper({site})", f"lower({site})", f"(' ' || {site} || ' ')")} AS "Event Location",
  {case_when_mod(k, 5, f"printf('%d:%02d', {k} % 3, ({k} % 4) * 15)", "'0 days 01:15:00'")} AS "Event Duration9",
  {case_when_mod(k, 6, "NULL", "'0'", "'2.0'", "'x'", f"CAST({c} % 9 AS VARCHAR)", f"CAST({c} % 9 AS VARCHAR)")} AS "Member Count"
FROM orders"""


def stacp_raw_sql() -> str:
    o, p, s, n = "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    return f"""SELECT
  CASE WHEN year(l_shipdate) >= 2000 THEN strftime(l_shipdate, '%m/%d/%y') ELSE strftime(l_shipdate, '%-m/%-d/%Y') END AS "Date",
  printf('%02d%02d', 7 + {n}, ({o} % 4) * 15) AS "Start Time",
  printf('%d:%02d', 8 + {n} + {p} % 3, ({p} % 4) * 15) AS "End Time",
  {case_when_mod(n, 4, f"printf('%d Hrs. %02d Mins', 1 + {o} % 5, ({o} % 2) * 30)", "'1 Hour '", "NULL",
                 f"printf('0 days %02d:%02d:00', {p} % 3, ({s} % 4) * 15)")} AS "Total Time",
  'Site ' || CAST({s} % 50 AS VARCHAR) AS "Location",
  'Outreach ' || l_returnflag || l_linestatus AS "School Outreach Conducted ",
  'Det. Officer' || CAST({s} % 20 AS VARCHAR) AS "Attendees",
  CASE WHEN {p} % 2 = 0 THEN 'Unit ' || CAST({p} % 7 AS VARCHAR) END AS "Attendees2",
  CASE WHEN {o} % 5 = 0 THEN '  ' END AS "Attendees3",
  CAST(NULL AS VARCHAR) AS "Attendees4",
  CAST(NULL AS VARCHAR) AS "Attendees5",
  {case_when_mod(p, 4, "'Vale / Fen'", "'moor, Hill'", "NULL", f"'Reed' || CAST({o} % 3 AS VARCHAR)")} AS "Free Type Attendees"
FROM lineitem"""


def patrol_raw_sql() -> str:
    c = "c_custkey"
    people = case_when_mod(c, 7, "NULL", f"CAST({c} % 5 AS VARCHAR)", "'Squad formation'",
                           f"'PO Rivers' || CAST({c} % 10 AS VARCHAR) || ' / Sgt. Stone and Lake'",
                           f"'P.Woods' || CAST({c} % 3 AS VARCHAR)", "'P.O. Woods & Det. Hill; Moor'",
                           "regexp_replace(c_name, '#', ' ', 'g')")
    return f"""SELECT {c} AS row_id,
  printf('1/%d/2024', 1 + {c} % 31) AS "Date",
  CAST(NULL AS VARCHAR) AS "Start Time", CAST(NULL AS VARCHAR) AS "End Time",
  c_mktsegment AS "Event Type",
  'Addr ' || CAST({c} % 10 AS VARCHAR) AS "Event Name",
  CASE WHEN {c} % 10 <> 0 THEN 'Site ' || CAST({c} % 50 AS VARCHAR) END AS "Event Location",
  {people} AS "Patrol Members Assigned"
FROM customer"""


def cad_raw_sql() -> str:
    e, u = "event_id", "user_id"
    secs = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
    back = f"(({secs} + CAST(floor(value * 60) AS BIGINT)) % 86400)"
    return f"""SELECT
  CASE WHEN {e} % 4 = 0 THEN printf('%d.0', 24000000 + {e}) ELSE CAST(24000000 + {e} AS VARCHAR) END AS "ReportNumberNew",
  ts AS "Time of Call",
  strftime(ts, '%H:%M:%S') AS "Time Out Display",
  CASE WHEN {e} % 10 <> 0 THEN {hms(back)} END AS "Time In Display",
  CASE WHEN {e} % 23 = 0 THEN 'BWC Review Q2' ELSE event_type END AS "Incident",
  CASE WHEN {u} % 3 = 0 THEN 'Site ' || CAST({u} % 50 AS VARCHAR) END AS "SelfJoinCADNumber::Business Name",
  {case_when_mod(u, 3, "NULL", f"printf('%d.0', {u} % 500)", f"CAST({u} % 90 AS VARCHAR) || 'B'")} AS "St Number",
  {case_when_mod(u, 4, "'Main St'", "'Elm Ave'", "NULL", "'Oak Rd'")} AS "StreetName",
  printf('Sgt. Ann%d Lane%d %d', {u} % 5, {u} % 11, 100 + {u} % 50) AS "Officer",
  {case_when_mod(e, 7, "'COMM ENG'", "'CSB'", "'STA'", "'A2'", "'B3'", "'XYZ'", "NULL")} AS "Squad",
  'D1' AS "DispatcherNew",
  {e} AS event_id
FROM events"""


# ---------------------------------------------------------------- canonical sources

PD = f"DATE {q(_dt.PROCESSED_DATE)}"


def community_canon_ctes() -> str:
    return f"""ce_raw AS ({community_raw_sql()}),
ce_t AS (SELECT row_id,
  {m2n('"Date of Event"')} AS t_date, {m2n('"Start Time"')} AS t_start, {m2n('"End Time"')} AS t_end,
  lower({m2n('"Event Duration9"')}) AS t_dur, "Member Count" AS t_cnt,
  {b2n('"Community Event"')} AS event_name, {b2n('"Event Location"')} AS location FROM ce_raw),
ce_p AS (SELECT *, {parse_date('t_date')} AS date, {clock_seconds('t_start')} AS start_s,
  {clock_seconds('t_end')} AS end_s, {duration_hours('t_dur')} AS given_raw FROM ce_t),
ce AS (SELECT row_id, date, {hhmm('start_s')} AS start_time, {hhmm('end_s')} AS end_time, event_name, location,
  round_even(coalesce({positive('given_raw')}, {positive(elapsed('start_s', 'end_s'))}, 0.5), 2) AS duration_hours,
  greatest(coalesce({to_long_trunc('t_cnt')}, 1), 1) AS attendee_count,
  'Community Engagement' AS office, 'Outreach' AS division, '' AS attendee_names,
  'outreach_log' AS data_source, {PD} AS processed_date FROM ce_p)"""


def _alias_lookup(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in _dt.DEMO_ALIASES.items())
    return f"coalesce(CASE lower({trim_ws(x)}) {whens} END, {x})"


def stacp_canon_ctes() -> str:
    singles = ", ".join(b2n(f'"{c}"') for c in ("Attendees", "Attendees2", "Attendees3", "Attendees4", "Attendees5"))
    free = trim_ws("coalesce(\"Free Type Attendees\", '')")
    free_parts = f"list_transform(string_split_regex({free}, {q(_p.FREE_TEXT_SPLIT)}), lambda x: {trim_ws('x')})"
    names = f"list_filter(list_concat([{singles}], {free_parts}), lambda x: x IS NOT NULL AND x <> '')"
    return f"""st_raw AS ({stacp_raw_sql()}),
st_t AS (SELECT {m2n('"Date"')} AS t_date, {m2n('"Start Time"')} AS t_start, {m2n('"End Time"')} AS t_end,
  lower({m2n('"Total Time"')}) AS t_dur, {b2n('"School Outreach Conducted "')} AS event_name,
  {b2n('"Location"')} AS location,
  list_transform({names}, lambda x: {_alias_lookup('x')}) AS names FROM st_raw),
st_p AS (SELECT *, {parse_date('t_date')} AS date, {clock_seconds('t_start')} AS start_s,
  {clock_seconds('t_end')} AS end_s, {duration_hours('t_dur')} AS given_raw FROM st_t),
st AS (SELECT date, {hhmm('start_s')} AS start_time, {hhmm('end_s')} AS end_time, event_name, location,
  round_even(coalesce({positive('given_raw')}, {positive(elapsed('start_s', 'end_s'))}, 0.5), 2) AS duration_hours,
  CAST(len(names) AS BIGINT) AS attendee_count, 'STA&CP' AS office, 'STACP' AS division,
  array_to_string(names, ', ') AS attendee_names, 'stacp' AS data_source, {PD} AS processed_date FROM st_p)"""


def patrol_canon_ctes() -> str:
    non = ", ".join(q(w) for w in _p.NON_NAME_ENTRIES)
    return f"""pa_raw AS ({patrol_raw_sql()}),
pa_t AS (SELECT row_id, {m2n('"Date"')} AS t_date, {m2n('"Start Time"')} AS t_start, {m2n('"End Time"')} AS t_end,
  {b2n('"Event Type"')} AS event_name, {b2n('"Event Location"')} AS location,
  {b2n('"Patrol Members Assigned"')} AS t_people FROM pa_raw),
pa_f AS (SELECT *, {parse_date('t_date')} AS date, {clock_seconds('t_start')} AS start_s,
  {clock_seconds('t_end')} AS end_s,
  CASE WHEN t_people IS NULL THEN CAST([] AS VARCHAR[])
       WHEN regexp_matches(t_people, '^\\d+$') THEN CAST([] AS VARCHAR[])
       WHEN lower(t_people) IN ({non}) THEN [t_people]
       ELSE {split_people('t_people')} END AS names,
  CASE WHEN t_people IS NULL THEN 0
       WHEN regexp_matches(t_people, '^\\d+$') THEN TRY_CAST(t_people AS BIGINT)
       WHEN lower(t_people) IN ({non}) THEN 0
       ELSE len({split_people('t_people')}) END AS n FROM pa_t),
pa AS (SELECT row_id, date, {hhmm('start_s')} AS start_time, {hhmm('end_s')} AS end_time, event_name, location,
  round_even({positive(elapsed('start_s', 'end_s'))}, 2) AS duration_hours,
  CAST(CASE WHEN n = 0 AND date IS NOT NULL AND event_name IS NOT NULL AND location IS NOT NULL THEN 1 ELSE n END AS BIGINT)
    AS attendee_count,
  'Patrol' AS office, 'Patrol' AS division, array_to_string(names, ', ') AS attendee_names,
  'patrol' AS data_source, {PD} AS processed_date FROM pa_f)"""


def cad_routed_ctes() -> str:
    num = b2n('"St Number"')
    patrol = ", ".join(q(s) for s, _, o, _ in ROUTE_ROWS if o == "Patrol")
    return f"""cad_raw AS ({cad_raw_sql()}),
cad_t AS (SELECT event_id, {m2n('"Time Out Display"')} AS t_out, {m2n('"Time In Display"')} AS t_in,
  {m2n('CAST("Time of Call" AS VARCHAR)')} AS t_call, {b2n('"Incident"')} AS event_name,
  {b2n('"SelfJoinCADNumber::Business Name"')} AS biz, {num} AS num, {b2n('"StreetName"')} AS street,
  {b2n('"Squad"')} AS squad, coalesce({b2n('"Officer"')}, '') AS attendee_names,
  regexp_replace(regexp_replace(coalesce({b2n('"ReportNumberNew"')}, ''), '[\\r\\n]', '', 'g'), '\\.0$', '') AS case_no
  FROM cad_raw),
cad_s AS (SELECT *, {clock_seconds('t_out')} AS out_s, {clock_seconds('t_in')} AS in_s,
  {parse_date('t_call')} AS date FROM cad_t),
cad_g AS (SELECT *, round_even((in_s - out_s) / 3600.0, 4) AS span,
  (out_s IS NOT NULL AND in_s IS NOT NULL) AS both_sides FROM cad_s),
cad_i AS (SELECT *, coalesce(both_sides AND span < CAST(2 AS DOUBLE) / 60, false) AS imputed FROM cad_g),
cad_routed AS (SELECT event_id, case_no, date, {hhmm('out_s')} AS start_time,
  {hhmm("CASE WHEN imputed THEN (out_s + 1800) % 86400 ELSE in_s END")} AS end_time,
  event_name,
  coalesce(biz, {trim_ws(f"concat_ws(' ', coalesce(CAST(TRY_CAST(trunc({to_double('num')}) AS BIGINT) AS VARCHAR), num, ''), coalesce(street, ''))")}) AS location,
  CASE WHEN imputed THEN 0.5 WHEN both_sides THEN span END AS duration_hours, imputed,
  CAST(1 AS BIGINT) AS attendee_count, squad, attendee_names,
  coalesce(squad <> 'CSB', true) AS include,
  CASE WHEN squad = 'COMM ENG' THEN 'Community Engagement' WHEN squad = 'CSB' THEN ''
       WHEN squad = 'STA' THEN 'STA&CP' WHEN squad IN ({patrol}) THEN 'Patrol' ELSE coalesce(squad, '') END AS office,
  CASE WHEN squad = 'COMM ENG' THEN 'Outreach' WHEN squad = 'STA' THEN 'STACP'
       WHEN squad IN ({patrol}) THEN 'Patrol' ELSE '' END AS division,
  'cad_ce' AS data_source, {PD} AS processed_date FROM cad_i)"""


CANON = ("date, start_time, end_time, event_name, location, duration_hours, attendee_count, "
         "office, division, attendee_names, data_source, processed_date")


def feed_ctes(gap_fill: bool = True) -> str:
    """Every CTE up to ``feed`` (the combined, filtered, gap-filled feed)."""
    gap = ("gap_kept AS (SELECT g.* FROM gap g WHERE NOT EXISTS (SELECT 1 FROM rec_keys r "
           "WHERE r.k_date = g.k_date AND r.k_loc = g.k_loc))" if gap_fill
           else "gap_kept AS (SELECT * FROM gap)")
    return f"""WITH {community_canon_ctes()},
{stacp_canon_ctes()},
{patrol_canon_ctes()},
{cad_routed_ctes()},
unioned AS (SELECT {CANON} FROM ce UNION ALL SELECT {CANON} FROM st UNION ALL SELECT {CANON} FROM pa
  UNION ALL SELECT {CANON} FROM cad_routed WHERE include),
kept AS (SELECT * FROM unioned WHERE NOT {contamination()}),
removed AS (SELECT * FROM unioned WHERE {contamination()}),
keyed AS (SELECT *, coalesce(strftime(date, '%Y-%m-%d'), '') AS k_date, {location_key('location')} AS k_loc FROM kept),
rec_keys AS (SELECT DISTINCT k_date, k_loc FROM keyed WHERE data_source <> 'cad_ce'),
gap AS (SELECT * FROM keyed WHERE data_source = 'cad_ce'),
{gap},
gap_dropped AS (SELECT g.* FROM gap g WHERE EXISTS (SELECT 1 FROM rec_keys r
  WHERE r.k_date = g.k_date AND r.k_loc = g.k_loc)),
feed AS (SELECT {CANON} FROM keyed WHERE data_source <> 'cad_ce' UNION ALL SELECT {CANON} FROM gap_kept)"""


def exact_sum(x: str) -> str:
    return f"CAST(coalesce(sum(CAST({x} AS DECIMAL(20, 4))), CAST(0 AS DECIMAL(20, 4))) AS DOUBLE)"
