"""Per-operator queries for the scalar rules, routing and reshaping
(DUR1-DUR4, TIM1, TIM2, DAT1-DAT4, STR1-STR14, NUM1-NUM5, JOI3, FLT2-FLT4,
SRC7, SRC8, REL4, FLT6, OUT2-OUT4, AGG12, VAL5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, durations, numbers, people, places
from ..functions.text import blank_to_null, missing_to_null
from ..operators import reshape
from ..operators.combine import apply_alias_table, route_split
from . import oracle_sql as S
from .catalog import register
from .driver_tables import table
from .feed import dispatch_routed

Q = S.q


# ------------------------------------------------------------------ DUR1

def _duration_text(li):
    q, n, k, p = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey")
    qi = F.floor(q)
    return (F.when(n % 6 == 0, qi.cast("string"))
            .when(n % 6 == 1, F.format_string("%d:30", qi % 24))
            .when(n % 6 == 2, F.format_string("%d:15:36", qi % 10))
            .when(n % 6 == 3, F.format_string("0 days %02d:%02d:00", qi % 24, (k % 4) * 15))
            .when(n % 6 == 4, F.format_string("%d Hrs. 00 Mins", qi % 9))
            .otherwise(F.when(p % 2 == 0, F.lit("junk")).otherwise(F.lit(" nan "))))


_DUR_TEXT_SQL = """CASE l_linenumber % 6
  WHEN 0 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)
  WHEN 1 THEN printf('%d:30', CAST(floor(l_quantity) AS BIGINT) % 24)
  WHEN 2 THEN printf('%d:15:36', CAST(floor(l_quantity) AS BIGINT) % 10)
  WHEN 3 THEN printf('0 days %02d:%02d:00', CAST(floor(l_quantity) AS BIGINT) % 24, (l_orderkey % 4) * 15)
  WHEN 4 THEN printf('%d Hrs. 00 Mins', CAST(floor(l_quantity) AS BIGINT) % 9)
  ELSE CASE WHEN l_partkey % 2 = 0 THEN 'junk' ELSE ' nan ' END END"""


@register("duration_parse", f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_DUR_TEXT_SQL} AS duration_text
  FROM lineitem),
n AS (SELECT *, lower({S.m2n('duration_text')}) AS t_dur FROM t),
h AS (SELECT *, {S.duration_hours('t_dur')} AS raw_hours FROM n)
SELECT l_orderkey, l_linenumber, l_partkey, duration_text,
  round_even({S.positive('raw_hours')}, 4) AS hours FROM h""")
def duration_parse(spark, sf_dir):
    """DUR1 over every line item: duration text in six layouts -> hours."""
    li = table(spark, sf_dir, "lineitem")
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", _duration_text(li).alias("duration_text"))
    n = t.select("*", durations.duration_text("duration_text").alias("t_dur"))
    return n.select("l_orderkey", "l_linenumber", "l_partkey", "duration_text",
                    numbers.round_half_even(durations.duration_hours("t_dur", normalized=True), 4)
                    .alias("hours"))


# ------------------------------------------------------------------ DUR2/DUR3/DAT2

def _clock_texts(ev):
    e = F.col("event_id")
    secs = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    end = (secs + F.floor(F.col("value") * 60)) % 86400
    h, m, s = F.floor(end / 3600).cast("int"), F.floor((end % 3600) / 60).cast("int"), (end % 60).cast("int")
    start_txt = (F.when(e % 3 == 0, F.date_format("ts", "HH:mm"))
                 .when(e % 3 == 1, F.date_format("ts", "HHmm"))
                 .otherwise(F.date_format("ts", "H:mm")))
    end_txt = (F.when(e % 4 == 0, F.format_string("%02d:%02d", h, m))
               .when(e % 4 == 1, F.format_string("%02d:%02d:%02d", h, m, s))
               .when(e % 8 == 2, F.lit("invalid"))
               .when(e % 16 == 6, F.concat(F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12).cast("string"),
                                           F.format_string(":%02d ", m), F.when(h < 12, "AM").otherwise("pm")))
               .when(e % 16 == 14, F.format_string("1899-12-30 %02d:%02d:%02d", h, m, s))
               .otherwise(F.format_string("%02d%02d", h, m)))
    return start_txt, end_txt


_END = "((hour(ts) * 3600 + minute(ts) * 60 + second(ts) + CAST(floor(value * 60) AS BIGINT)) % 86400)"
_EH, _EM, _ES = (f"CAST(floor({_END} / 3600) AS BIGINT)", f"CAST(floor(({_END} % 3600) / 60) AS BIGINT)",
                 f"CAST({_END} % 60 AS BIGINT)")
_CLOCK_SQL = f"""SELECT event_id,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%H:%M') WHEN 1 THEN strftime(ts, '%H%M') ELSE strftime(ts, '%-H:%M') END AS start_text,
  CASE event_id % 4 WHEN 0 THEN printf('%02d:%02d', {_EH}, {_EM}) WHEN 1 THEN printf('%02d:%02d:%02d', {_EH}, {_EM}, {_ES})
    WHEN 2 THEN CASE WHEN event_id % 8 = 2 THEN 'invalid'
      WHEN event_id % 16 = 6 THEN (CASE WHEN {_EH} % 12 = 0 THEN 12 ELSE {_EH} % 12 END) || printf(':%02d ', {_EM})
        || (CASE WHEN {_EH} < 12 THEN 'AM' ELSE 'pm' END)
      ELSE printf('1899-12-30 %02d:%02d:%02d', {_EH}, {_EM}, {_ES}) END
    ELSE printf('%02d%02d', {_EH}, {_EM}) END AS end_text
FROM events"""


@register("elapsed_wrap", f"""WITH t AS ({_CLOCK_SQL}),
s AS (SELECT *, {S.clock_seconds(S.m2n('start_text'))} AS start_s, {S.clock_seconds(S.m2n('end_text'))} AS end_s FROM t)
SELECT event_id, start_text, end_text, start_s, end_s,
  round_even({S.elapsed('start_s', 'end_s')}, 4) AS elapsed_hours,
  round_even(coalesce({S.positive(S.elapsed('start_s', 'end_s'))}, 0.5), 2) AS duration_hours FROM s""")
def elapsed_wrap(spark, sf_dir):
    """DAT2 clock text in six layouts, DUR2 elapsed with midnight wrap, DUR3 fallback."""
    ev = table(spark, sf_dir, "events")
    st, et = _clock_texts(ev)
    t = ev.select("event_id", st.alias("start_text"), et.alias("end_text"))
    s = t.select("*", durations.clock_seconds("start_text").alias("start_s"),
                 durations.clock_seconds("end_text").alias("end_s"))
    el = durations.elapsed_hours("start_s", "end_s")
    return s.select("*", numbers.round_half_even(el, 4).alias("elapsed_hours"),
                    durations.pick_duration(F.lit(None).cast("double"), el).alias("duration_hours"))


# ------------------------------------------------------------------ DUR4/TIM1/TIM2/OUT3

_CAD = "WITH " + S.cad_routed_ctes()


@register("impute_short_spans", f"""{_CAD}
SELECT event_id, case_no, start_time, end_time, duration_hours, squad FROM cad_routed WHERE imputed""")
def impute_short_spans(spark, sf_dir):
    """DUR4 memorial guard + OUT3 listing: dispatch rows whose span was imputed."""
    r = dispatch_routed(spark, sf_dir)
    return r.where("imputed").select("event_id", "case_no", "start_time", "end_time",
                                     "duration_hours", "squad")


@register("compose_location", f"""{_CAD}
SELECT event_id, case_no, location FROM cad_routed""")
def compose_location(spark, sf_dir):
    """STR7 business name / number + street, STR1 case numbers, for every dispatch row."""
    return dispatch_routed(spark, sf_dir).select("event_id", "case_no", "location")


# ------------------------------------------------------------------ NUM5/FLT2/OUT2/OUT4

@register("route_codes", f"""{_CAD}
SELECT CASE WHEN NOT include THEN 'csb' WHEN squad = 'STA' THEN 'sta' ELSE 'csv' END AS dest,
  office, division, count(*) AS n FROM cad_routed GROUP BY ALL""")
def route_codes(spark, sf_dir):
    """NUM5 routing (broadcast route table) split into the OUT4 destinations."""
    r = route_split(dispatch_routed(spark, sf_dir))
    allr = r["csv"].unionByName(r["sta"]).unionByName(r["csb"])
    return allr.groupBy("dest", "office", "division").agg(F.count(F.lit(1)).alias("n"))


@register("unrouted_rows", f"""{_CAD}
SELECT event_id, squad, 'squad ' || coalesce(squad, '<blank>') || ' excluded from the feed' AS reason
FROM cad_routed WHERE NOT include""")
def unrouted_rows(spark, sf_dir):
    """FLT2 / OUT2: rows the routing excludes, with the reason."""
    return route_split(dispatch_routed(spark, sf_dir))["unrouted"].select("event_id", "squad", "reason")


@register("conservation", f"""{_CAD},
raw AS (SELECT count(*) FILTER (WHERE date >= DATE '2024-01-01' AND date < DATE '2024-02-01') AS in_period,
  count(*) FILTER (WHERE squad = 'STA' AND date >= DATE '2024-01-01' AND date < DATE '2024-02-01') AS sta,
  count(*) FILTER (WHERE squad = 'CSB' AND date >= DATE '2024-01-01' AND date < DATE '2024-02-01') AS csb,
  count(*) FILTER (WHERE include AND coalesce(squad, '') <> 'STA' AND date >= DATE '2024-01-01'
    AND date < DATE '2024-02-01') AS output,
  count(*) FILTER (WHERE include AND coalesce(squad, '') <> 'STA' AND date >= DATE '2024-01-01'
    AND date < DATE '2024-02-01' AND (office IS NULL OR trim(office) = '')) AS blank_office,
  count(*) FILTER (WHERE date IS NULL OR date < DATE '2024-01-01' OR date >= DATE '2024-02-01') AS out_of_period
  FROM cad_routed)
SELECT *, (output = in_period - sta - csb) AS conserved FROM raw""")
def conservation(spark, sf_dir):
    """AGG12 conservation (output = in-period - STA - CSB) and VAL5 gates, one pass.

    The target month comes from an export file name (SRC7)."""
    first = dates.period_from_file_name(F.lit("2024_01_CE_export.xlsx"))
    r = dispatch_routed(spark, sf_dir)
    inp = dates.in_period(F.col("date"), first)
    sq = F.coalesce(F.col("squad"), F.lit(""))
    out = inp & F.col("include") & (sq != "STA")
    agg = r.agg(
        F.count_if(inp).alias("in_period"),
        F.count_if(inp & (sq == "STA")).alias("sta"),
        F.count_if(inp & (sq == "CSB")).alias("csb"),
        F.count_if(out).alias("output"),
        F.count_if(out & (F.col("office").isNull() | (F.trim("office") == ""))).alias("blank_office"),
        F.count_if(~F.coalesce(inp, F.lit(False))).alias("out_of_period"))
    return agg.withColumn("conserved", F.col("output") == F.col("in_period") - F.col("sta") - F.col("csb"))


# ------------------------------------------------------------------ DAT1/DAT3

def _date_text(o):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return (F.when(k % 15 == 0, F.date_format(d, "MM/dd/yyyy HH:mm:ss"))
            .when(k % 15 == 5, F.date_format(d, "yyyy/MM/dd"))
            .when(k % 30 == 17, F.date_format(d, "MMM d, yyyy"))
            .when(k % 30 == 2, F.date_format(d, "MMMM dd yyyy"))
            .when(k % 5 == 0, F.date_format(d, "MM/dd/yyyy"))
            .when(k % 5 == 1, F.when(F.year(d) >= 2000, F.date_format(d, "MM/dd/yy"))
                  .otherwise(F.date_format(d, "yyyy-MM-dd")))
            .when(k % 5 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 5 == 3, F.format_string("%02d%02d", k % 24, k % 60))
            .otherwise(F.when(k % 2 == 0, F.lit("02/30/2026")).otherwise(F.lit("  "))))


_DATE_TEXT_SQL = """CASE WHEN o_orderkey % 15 = 0 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
  WHEN o_orderkey % 15 = 5 THEN strftime(o_orderdate, '%Y/%m/%d')
  WHEN o_orderkey % 30 = 17 THEN strftime(o_orderdate, '%b %-d, %Y')
  WHEN o_orderkey % 30 = 2 THEN strftime(o_orderdate, '%B %d %Y') ELSE CASE o_orderkey % 5
  WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN 1 THEN CASE WHEN year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%m/%d/%y') ELSE strftime(o_orderdate, '%Y-%m-%d') END
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN 3 THEN printf('%02d%02d', o_orderkey % 24, o_orderkey % 60)
  ELSE CASE WHEN o_orderkey % 2 = 0 THEN '02/30/2026' ELSE '  ' END END END"""
_DATES = f"""WITH t AS (SELECT o_orderkey, {_DATE_TEXT_SQL} AS date_text FROM orders),
n AS (SELECT *, {S.m2n('date_text')} AS t_date FROM t),
p AS (SELECT *, {S.parse_date('t_date')} AS parsed_date FROM n)"""


@register("parse_mixed_dates", f"""{_DATES}
SELECT o_orderkey, date_text, parsed_date, coalesce(strftime(parsed_date, '%Y-%m-%d'), t_date, '') AS date_key FROM p""")
def parse_mixed_dates(spark, sf_dir):
    """DAT1 over every order: nine text layouts (incl. clock-like junk and impossible days)."""
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", _date_text(o).alias("date_text"))
    n = t.select("*", missing_to_null("date_text").alias("t_date"))
    p = n.select("*", dates.parse_date("t_date", normalized=True).alias("parsed_date"))
    return p.select("o_orderkey", "date_text", "parsed_date",
                    F.coalesce(F.date_format("parsed_date", "yyyy-MM-dd"), F.col("t_date"), F.lit(""))
                    .alias("date_key"))


@register("date_parse_rate", f"""{_DATES}
SELECT count(*) AS rows, count(t_date) AS nonblank, count(parsed_date) AS parsed,
  count(t_date) - count(parsed_date) AS failed,
  CASE WHEN count(t_date) > 0 THEN round_even(count(parsed_date) * 100.0 / count(t_date), 1) ELSE 0.0 END AS rate_nonblank,
  CASE WHEN count(*) > 0 THEN round_even(count(parsed_date) * 100.0 / count(*), 1) ELSE 0.0 END AS rate_all,
  min(parsed_date) AS first_date, max(parsed_date) AS last_date FROM p""")
def date_parse_rate(spark, sf_dir):
    """DAT3 success / failure counts and rates, AGG5 range, one pass."""
    p = parse_mixed_dates(spark, sf_dir)
    return p.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(missing_to_null("date_text")).alias("nonblank"),
        F.count("parsed_date").alias("parsed"),
        (F.count(missing_to_null("date_text")) - F.count("parsed_date")).alias("failed"),
        numbers.pct(F.count("parsed_date"), F.count(missing_to_null("date_text"))).alias("rate_nonblank"),
        numbers.pct(F.count("parsed_date"), F.count(F.lit(1))).alias("rate_all"),
        F.min("parsed_date").alias("first_date"), F.max("parsed_date").alias("last_date"))


# ------------------------------------------------------------------ FLT3/FLT4/SRC7/DAT4

@register("period_filter", """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
  count(*) AS n_orders, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total_cents
FROM orders WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01' GROUP BY ALL""")
def period_filter(spark, sf_dir):
    """FLT3 month filter (sargable, pushed to the scan), period from a file name (SRC7), DAT4."""
    first = dates.period_from_file_name(F.lit("1998_03_CE_orders.xlsx"))
    o = table(spark, sf_dir, "orders", spread=False)
    d = F.col("o_orderdate")
    # compare the timestamp column with timestamp bounds so the predicate reaches parquet
    f = o.where((d >= first.cast("timestamp_ntz")) & (d < F.add_months(first, 1).cast("timestamp_ntz")))
    return f.groupBy(F.year(d).alias("year"), F.month(d).alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents"))


@register("rolling_window", """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n_orders
FROM orders WHERE o_orderdate >= DATE '1999-06-01' AND o_orderdate < DATE '2000-07-01' GROUP BY ALL""")
def rolling_window(spark, sf_dir):
    """FLT4 13-calendar-month window ending in the month of ``as_of`` (2000-06-15)."""
    o = table(spark, sf_dir, "orders", spread=False)
    as_of = F.lit("2000-06-15").cast("date")
    d = F.col("o_orderdate")
    return o.where(dates.rolling_months(d.cast("date"), as_of, 13)).groupBy(F.year(d).alias("year"), F.month(d).alias("month")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))


# ------------------------------------------------------------------ STR2-STR6

def _loc_text():
    k = F.col("p_partkey")
    return (F.when(k % 4 == 0, F.col("p_name"))
            .when(k % 4 == 1, F.concat(F.col("p_name"), F.lit(" and "), F.col("p_type")))
            .when(k % 4 == 2, F.concat(F.upper("p_brand"), F.lit(" & "), F.col("p_name")))
            .otherwise(F.concat(F.lit("The "), F.col("p_name"), F.lit(" / "), F.col("p_size").cast("string"))))


_LOC_SQL = """CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' and ' || p_type
  WHEN 2 THEN upper(p_brand) || ' & ' || p_name ELSE 'The ' || p_name || ' / ' || CAST(p_size AS VARCHAR) END"""


@register("location_key", f"""WITH t AS (SELECT p_partkey, {_LOC_SQL} AS location FROM part)
SELECT p_partkey, location, {S.location_key('location')} AS loc_key,
  array_to_string({S.location_tokens('location')}, '|') AS tokens,
  coalesce(regexp_matches(lower({S.b2n('location')}), {Q(places.COMBINED_PATTERN)}), false) AS is_combined,
  array_to_string(string_split_regex(lower(coalesce(location, '')), {Q(places.COMBINED_PATTERN)}), '|') AS parts
FROM t""")
def location_key(spark, sf_dir):
    """STR2 collapsed key, STR3 token set, STR5 combined test, STR6 components, per part."""
    p = table(spark, sf_dir, "part").select("p_partkey", _loc_text().alias("location"))
    return p.select("p_partkey", "location", places.location_key("location").alias("loc_key"),
                    F.array_join(places.location_tokens("location"), "|").alias("tokens"),
                    places.is_combined("location").alias("is_combined"),
                    F.array_join(places.location_parts("location"), "|").alias("parts"))


# ------------------------------------------------------------------ STR10-STR12/NUM3

@register("patrol_field", f"""WITH {S.patrol_canon_ctes()}
SELECT row_id AS c_custkey, t_people AS people_text, array_to_string(names, '; ') AS names, n AS n_parsed,
  CAST(CASE WHEN n = 0 AND date IS NOT NULL AND event_name IS NOT NULL AND location IS NOT NULL THEN 1 ELSE n END AS BIGINT)
    AS attendee_count
FROM pa_f""")
def patrol_field(spark, sf_dir):
    """STR10 rank strip, STR11 split, STR12 field rules, NUM3 fallback, per customer row."""
    from .driver_tables import patrol_raw
    raw = patrol_raw(spark, sf_dir)
    f = raw.select(F.col("row_id").alias("c_custkey"),
                   blank_to_null("Patrol Members Assigned").alias("people_text"),
                   dates.parse_date("Date").alias("date"), blank_to_null("Event Type").alias("ev"),
                   blank_to_null("Event Location").alias("loc"))
    g = f.select("*", people.patrol_field("people_text").alias("pf"))
    n = F.col("pf.n")
    return g.select("c_custkey", "people_text", F.array_join("pf.names", "; ").alias("names"),
                    n.alias("n_parsed"),
                    F.when((n == 0) & F.col("date").isNotNull() & F.col("ev").isNotNull()
                           & F.col("loc").isNotNull(), F.lit(1).cast("long")).otherwise(n)
                    .alias("attendee_count"))


# ------------------------------------------------------------------ STR8/STR9

def _officer_text():
    k = F.col("c_custkey")
    rank = (F.when(k % 4 == 0, F.lit("Lt. ")).when(k % 4 == 1, F.lit("Sgt. "))
            .when(k % 4 == 2, F.lit("P.O. ")).otherwise(F.lit("")))
    return F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(rank, F.lit("Ann"), (k % 7).cast("string"), F.lit(" Lane"), (k % 11).cast("string"),
                 F.lit(" "), (100 + k).cast("string"),
                 F.when(k % 5 == 0, F.lit(".")).otherwise(F.lit(""))))


_OFFICER_SQL = """CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE
  (CASE c_custkey % 4 WHEN 0 THEN 'Lt. ' WHEN 1 THEN 'Sgt. ' WHEN 2 THEN 'P.O. ' ELSE '' END)
  || 'Ann' || CAST(c_custkey % 7 AS VARCHAR) || ' Lane' || CAST(c_custkey % 11 AS VARCHAR) || ' '
  || CAST(100 + c_custkey AS VARCHAR) || CASE WHEN c_custkey % 5 = 0 THEN '.' ELSE '' END END"""


def _sql_officer_tokens(x):
    return (f"list_filter(string_split_regex({S.trim_ws(f'coalesce({x}, {Q(str())})')}, '\\s+'), "
            f"lambda t: t <> '' AND NOT regexp_matches(regexp_replace(t, '\\.+$', ''), '^\\d+$') "
            f"AND NOT suffix(t, '.'))")


@register("officer_forms", f"""WITH t AS (SELECT c_custkey, {_OFFICER_SQL} AS officer FROM customer),
k AS (SELECT *, {_sql_officer_tokens('officer')} AS toks FROM t)
SELECT c_custkey, officer, coalesce(lower(toks[-1]), '') AS officer_key,
  CASE WHEN len(toks) >= 2 THEN left(toks[1], 1) || '. ' || array_to_string(toks[2:], ' ')
       ELSE array_to_string(toks, ' ') END AS initial_form FROM k""")
def officer_forms(spark, sf_dir):
    """STR8 officer key and STR9 ``F. Last`` form, per customer-derived officer text."""
    c = table(spark, sf_dir, "customer").select("c_custkey", _officer_text().alias("officer"))
    return c.select("c_custkey", "officer", people.officer_key("officer").alias("officer_key"),
                    people.officer_initial_form("officer").alias("initial_form"))


# ------------------------------------------------------------------ NUM1/NUM4

@register("head_count", """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '0'
  WHEN 2 THEN '2.0' WHEN 3 THEN 'x' WHEN 4 THEN '-3' WHEN 5 THEN ' 4 ' ELSE '1e1' END AS count_text FROM orders),
d AS (SELECT *, """ + S.to_double("count_text") + """ AS v FROM t)
SELECT o_orderkey, count_text, greatest(coalesce(CAST(trunc(v) AS BIGINT), 1), 1) AS given_count,
  CASE WHEN CAST(trunc(v) AS BIGINT) IS NULL OR CAST(trunc(v) AS BIGINT) <= 0 THEN 1 ELSE CAST(trunc(v) AS BIGINT) END
    AS presentation_count FROM d""")
def head_count(spark, sf_dir):
    """NUM1 given head count and NUM4 presentation clamp, per order."""
    k = F.col("o_orderkey")
    txt = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, "0").when(k % 7 == 2, "2.0")
           .when(k % 7 == 3, "x").when(k % 7 == 4, "-3").when(k % 7 == 5, " 4 ").otherwise("1e1"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", txt.alias("count_text"))
    return o.select("o_orderkey", "count_text", numbers.given_head_count("count_text").alias("given_count"),
                    numbers.clamp_presentation_count("count_text").alias("presentation_count"))


# ------------------------------------------------------------------ STR13/STR14/JOI3/NUM2

def _roster_cols():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    primary = F.concat(F.lit("nation_"), (c % 25).cast("string"))
    extra1 = F.when(k % 3 == 0, F.concat(F.lit("NATION_"), (k % 25).cast("string")))
    extra2 = F.when(k % 4 == 0, F.lit("Moor"))
    free = (F.when(k % 5 == 0, F.lit("Vale / Fen")).when(k % 5 == 1, F.lit("a, b , c"))
            .when(k % 5 == 2, F.lit(None).cast("string"))
            .when(k % 5 == 3, F.concat(F.lit(" nation_"), (k % 7).cast("string"), F.lit(" ")))
            .otherwise(F.lit("")))
    return primary.alias("primary"), extra1.alias("extra1"), extra2.alias("extra2"), free.alias("free_text")


_ROSTER_SQL = """SELECT o_orderkey, 'nation_' || CAST(o_custkey % 25 AS VARCHAR) AS "primary",
  CASE WHEN o_orderkey % 3 = 0 THEN 'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) END AS extra1,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Moor' END AS extra2,
  CASE o_orderkey % 5 WHEN 0 THEN 'Vale / Fen' WHEN 1 THEN 'a, b , c' WHEN 2 THEN NULL
    WHEN 3 THEN ' nation_' || CAST(o_orderkey % 7 AS VARCHAR) || ' ' ELSE '' END AS free_text FROM orders"""


def _sql_roster_names():
    singles = ", ".join(S.b2n(c) for c in ('"primary"', "extra1", "extra2"))
    free = S.trim_ws("coalesce(free_text, '')")
    parts = f"list_transform(string_split_regex({free}, {Q(people.FREE_TEXT_SPLIT)}), lambda x: {S.trim_ws('x')})"
    return f"list_filter(list_concat([{singles}], {parts}), lambda x: x IS NOT NULL AND x <> '')"


def _sql_simple_count(x):
    return (f"len(list_filter(string_split_regex(coalesce(CAST({x} AS VARCHAR), ''), '[,/&]'), "
            f"lambda p: {S.trim_ws('p')} <> ''))")


@register("roster_alias", f"""WITH r AS ({_ROSTER_SQL}),
alias AS (SELECT lower({S.trim_ws('n_name')}) AS k, min('Officer ' || n_name || ' (' || CAST(n_regionkey AS VARCHAR) || ')') AS canon
  FROM nation GROUP BY 1),
nm AS (SELECT *, {_sql_roster_names()} AS names FROM r),
ex AS (SELECT o_orderkey, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM nm),
j AS (SELECT ex.*, a.canon FROM ex LEFT JOIN alias a ON lower({S.trim_ws('ex.name')}) = a.k),
agg AS (SELECT o_orderkey, string_agg(coalesce(canon, name), ', ' ORDER BY pos) AS names, count(*) AS n FROM j GROUP BY o_orderkey)
SELECT nm.o_orderkey, coalesce(agg.names, '') AS attendee_names, CAST(coalesce(agg.n, 0) AS BIGINT) AS attendee_count,
  CAST((CASE WHEN {S.b2n('"primary"')} IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN {S.b2n('extra1')} IS NOT NULL THEN 1 ELSE 0 END)
   + (CASE WHEN {S.b2n('extra2')} IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN {S.b2n('free_text')} IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
    AS nonblank_cells,
  CAST({_sql_simple_count('"primary"')} + {_sql_simple_count('free_text')} AS BIGINT) AS simple_count
FROM nm LEFT JOIN agg ON nm.o_orderkey = agg.o_orderkey""")
def roster_alias(spark, sf_dir):
    """STR14 roster, JOI3 alias *table* join (from ``nation``), NUM2 and STR13 counts, per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", *_roster_cols())
    nm = o.select("*", people.roster_names("primary", ["extra1", "extra2"], "free_text").alias("names"))
    nat = table(spark, sf_dir, "nation")
    alias = nat.select(F.col("n_name").alias("alias_key"),
                       F.concat(F.lit("Officer "), F.col("n_name"), F.lit(" ("),
                                F.col("n_regionkey").cast("string"), F.lit(")")).alias("canonical"))
    aliased = apply_alias_table(nm.select("o_orderkey", "names"), alias, "o_orderkey", "names")
    j = nm.drop("names").join(aliased, "o_orderkey", "left")
    return j.select("o_orderkey",
                    F.coalesce(F.array_join("names", ", "), F.lit("")).alias("attendee_names"),
                    F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("attendee_count"),
                    people.nonblank_count("primary", "extra1", "extra2", "free_text").alias("nonblank_cells"),
                    people.simple_count("primary", "free_text").alias("simple_count"))


# ------------------------------------------------------------------ REL4/FLT6/SRC8

_GRID_SQL = """WITH c AS (SELECT strftime(ts, '%y_%m') AS sheet, event_type AS activity, day(ts) AS d, count(*) AS n
  FROM events GROUP BY ALL),
cells AS (SELECT sheet, activity, CAST(d AS VARCHAR) AS day_label, n FROM c
  UNION ALL SELECT sheet, activity, 'Total', sum(n) FROM c GROUP BY sheet, activity)
SELECT TRY_CAST(printf('%04d-%02d-%02d', 2000 + CAST(left(sheet, 2) AS INTEGER), CAST(right(sheet, 2) AS INTEGER),
    CASE WHEN day_label = 'Total' THEN 1 ELSE CAST(day_label AS INTEGER) END) AS DATE) AS date,
  '08:00' AS start_time, '17:00' AS end_time,
  CASE WHEN day_label = 'Total' THEN activity || ' (Monthly Total)' ELSE activity END AS event_name,
  'Various' AS location, 8.0 AS duration_hours, CAST(n AS BIGINT) AS attendee_count, sheet
FROM cells WHERE n > 0"""


@register("grid_unpivot", _GRID_SQL)
def grid_unpivot(spark, sf_dir):
    """REL4: events -> (sheet x activity x day) count grid via pivot, then the grid
    is unpivoted back into one event per non-zero cell plus monthly totals (SRC8 period)."""
    ev = table(spark, sf_dir, "events")
    src = ev.select(F.date_format("ts", "yy_MM").alias("sheet"), F.col("event_type").alias("activity"),
                    F.dayofmonth("ts").alias("day"))
    grid = reshape.counts_to_grid(src, "sheet", "activity", "day")
    events, _rejects = reshape.grid_to_events(grid)
    return events.select("date", "start_time", "end_time", "event_name", "location", "duration_hours",
                         "attendee_count", "sheet")


@register("grid_rejects", """SELECT DISTINCT strftime(ts, '%y_%m') AS sheet, event_type AS activity, '31' AS day_label, 'n/a' AS cell
FROM events WHERE event_type = 'click'""")
def grid_rejects(spark, sf_dir):
    """REL4: cells of the count grid that are no number are listed, not dropped."""
    ev = table(spark, sf_dir, "events")
    src = ev.select(F.date_format("ts", "yy_MM").alias("sheet"), F.col("event_type").alias("activity"),
                    F.dayofmonth("ts").alias("day"))
    grid = reshape.counts_to_grid(src, "sheet", "activity", "day")
    junk = grid.withColumn("31", F.when(F.col("activity") == "click", F.lit("n/a")).otherwise(F.col("31").cast("string")))
    _, rejects = reshape.grid_to_events(junk)
    return rejects


@register("inverted_spans", f"""WITH t AS ({_CLOCK_SQL}),
s AS (SELECT *, {S.clock_seconds(S.m2n('start_text'))} AS start_s, {S.clock_seconds(S.m2n('end_text'))} AS end_s FROM t),
d AS (SELECT *, round_even((end_s - start_s) / 3600.0, 4) AS span FROM s)
SELECT event_id, CASE WHEN span >= 0 AND end_s >= start_s THEN CASE WHEN span < 2 / 60.0 THEN 0.5 ELSE span END END AS duration_hours,
  coalesce(end_s >= start_s AND span < 2 / 60.0, false) AS imputed FROM d""")
def inverted_spans(spark, sf_dir):
    """DUR4 with ``on_inversion='reject'``: spans that end before they start have no duration."""
    ev = table(spark, sf_dir, "events")
    st, et = _clock_texts(ev)
    s = ev.select("event_id", durations.clock_seconds(st).alias("start_s"), durations.clock_seconds(et).alias("end_s"))
    dur, imputed, _ = durations.memorial_guard("start_s", "end_s", on_inversion="reject")
    return s.select("event_id", dur.alias("duration_hours"), F.coalesce(imputed, F.lit(False)).alias("imputed"))
