"""Matching queries: gap-fill anti/semi join on events (JOI1) and the
reconciliation of dispatch-like rows against a log (JOI2, AGG11, OUT1, WIN2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import places
from ..operators import reconcile as R
from ..operators import report
from ..operators.combine import gap_fill
from . import oracle_sql as S
from .catalog import register
from .driver_tables import table

Q = S.q


# ------------------------------------------------------------------ JOI1 on events

def _gap_sides(spark, sf_dir):
    ev = table(spark, sf_dir, "events", spread=False).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("date"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("location"))
    click = F.col("event_type") == "click"
    return ev.where(~F.coalesce(click, F.lit(False))), ev.where(click)


_GAP_SQL = """WITH ev AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS date,
  regexp_replace(lower('user ' || CAST(user_id AS VARCHAR)), '[^a-z0-9]', '', 'g') AS k_loc FROM events),
rec AS (SELECT DISTINCT coalesce(strftime(date, '%Y-%m-%d'), '') AS k_date, k_loc FROM ev WHERE event_type IS DISTINCT FROM 'click'),
gap AS (SELECT *, coalesce(strftime(date, '%Y-%m-%d'), '') AS k_date FROM ev WHERE event_type = 'click')"""


@register("gapfill", f"""{_GAP_SQL}
SELECT event_id, user_id, date FROM gap g WHERE NOT EXISTS
  (SELECT 1 FROM rec r WHERE r.k_date = g.k_date AND r.k_loc = g.k_loc)""")
def gapfill(spark, sf_dir):
    """JOI1: click events kept only where no other event covers the same (day, user)."""
    record, gap = _gap_sides(spark, sf_dir)
    kept, _ = gap_fill(record, gap)
    return kept.select("event_id", "user_id", "date")


@register("gapfill_dropped", f"""{_GAP_SQL}
SELECT event_id, user_id, date FROM gap g WHERE EXISTS
  (SELECT 1 FROM rec r WHERE r.k_date = g.k_date AND r.k_loc = g.k_loc)""")
def gapfill_dropped(spark, sf_dir):
    """JOI1 audit (left semi): click events that another event already covers."""
    record, gap = _gap_sides(spark, sf_dir)
    _, dropped = gap_fill(record, gap)
    return dropped.select("event_id", "user_id", "date")


# ------------------------------------------------------------------ JOI2 on part

def _brand_no():
    return F.regexp_extract("p_brand", r"Brand#(\d+)", 1).try_cast("int")


def recon_sides(spark, sf_dir):
    """Dispatch-like rows and log rows, both derived from every ``part`` row."""
    p = table(spark, sf_dir, "part")
    k, b = F.col("p_partkey"), _brand_no()
    second = F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    first = F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(1)), F.lit(""))
    cad = p.select(
        k.alias("cad_id"),
        F.when(k % 13 == 0, F.lit(None).cast("date"))
         .otherwise(F.make_date(F.lit(2024), 1 + b % 12, 1 + F.col("p_size") % 28)).alias("date"),
        (F.when(k % 5 == 0, F.col("p_name")).when(k % 5 == 1, F.upper("p_name"))
         .when(k % 5 == 2, F.concat(F.col("p_name"), F.lit(" center"))).when(k % 5 == 3, second)
         .otherwise(F.concat(F.lit("The "), F.col("p_name")))).alias("location"),
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 6, "0")).alias("case_no"),
        F.col("p_type").alias("event_name"),
        ((k * 97) % 86400).cast("int").alias("call_s"),
        F.lit(None).cast("string").alias("start_time"),
        F.concat(F.lit("Det. Ann"), (k % 7).cast("string"), F.lit(" Lane"), (k % 11).cast("string"),
                 F.lit(" "), (200 + k % 50).cast("string")).alias("attendee_names"))
    log = p.select(
        (k + 2).alias("row_idx"),
        F.make_date(F.lit(2024), 1 + b % 12, 1 + (F.col("p_size") + k % 2) % 28).alias("date"),
        (F.when(k % 6 == 1, F.concat(F.col("p_name"), F.lit(" and "), F.lower("p_type")))
         .when(k % 6 == 2, F.lower("p_type"))
         .when(k % 6 == 3, F.concat(F.col("p_name"), F.lit(" / gym")))
         .when(k % 6 == 4, F.concat(F.lit("M & M "), first))
         .otherwise(F.col("p_name"))).alias("location"))
    return cad, log


_BRAND = "TRY_CAST(regexp_extract(p_brand, 'Brand#(\\d+)', 1) AS INTEGER)"
_SIDES_SQL = f"""cad AS (SELECT p_partkey AS cad_id,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE make_date(2024, 1 + {_BRAND} % 12, 1 + p_size % 28) END AS date,
  CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || ' center'
    WHEN 3 THEN split_part(p_name, ' ', 2) ELSE 'The ' || p_name END AS location,
  'P' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS case_no, p_type AS event_name,
  CAST((p_partkey * 97) % 86400 AS INTEGER) AS call_s,
  'Det. Ann' || CAST(p_partkey % 7 AS VARCHAR) || ' Lane' || CAST(p_partkey % 11 AS VARCHAR) || ' '
    || CAST(200 + p_partkey % 50 AS VARCHAR) AS attendee_names FROM part),
lg AS (SELECT p_partkey + 2 AS row_idx, make_date(2024, 1 + {_BRAND} % 12, 1 + (p_size + p_partkey % 2) % 28) AS date,
  CASE p_partkey % 6 WHEN 1 THEN p_name || ' and ' || lower(p_type) WHEN 2 THEN lower(p_type)
    WHEN 3 THEN p_name || ' / gym' WHEN 4 THEN 'M & M ' || split_part(p_name, ' ', 1) ELSE p_name END AS location
  FROM part)"""


def _sql_match(ck, ct, lk, lt):
    jac = (f"(len({ct}) > 0 AND len({lt}) > 0 AND len(list_intersect({ct}, {lt})) / "
           f"len(list_distinct(list_concat({ct}, {lt}))) >= 0.5)")
    return (f"({ck} <> '' AND {lk} <> '' AND ({ck} = {lk} OR contains({lk}, {ck}) OR contains({ck}, {lk}) "
            f"OR {jac}))")


_PART_MATCH = _sql_match("c.ckey", "c.ctok", S.location_key("p"), S.location_tokens("p"))
_RECON_SQL = f"""WITH {_SIDES_SQL},
ck AS (SELECT *, {S.location_key('location')} AS ckey, {S.location_tokens('location')} AS ctok FROM cad),
lk AS (SELECT *, {S.location_key('location')} AS lkey, {S.location_tokens('location')} AS ltok,
  coalesce(regexp_matches(lower({S.b2n('location')}), {Q(places.COMBINED_PATTERN)}), false) AS comb,
  string_split_regex(lower(coalesce(location, '')), {Q(places.COMBINED_PATTERN)}) AS parts FROM lg),
pairs AS (SELECT c.cad_id, l.row_idx,
  {_sql_match('c.ckey', 'c.ctok', 'l.lkey', 'l.ltok')} AS full_match,
  (l.comb AND len(c.ctok) > 0 AND (len(list_filter(l.parts, lambda p: {_PART_MATCH})) > 0
    OR len(list_intersect(c.ctok, l.ltok)) >= 1)) AS part_match
  FROM ck c JOIN lk l ON c.date = l.date),
agg AS (SELECT cad_id, min(row_idx) FILTER (WHERE full_match) AS present_row,
  min(row_idx) FILTER (WHERE part_match) AS split_row, count(*) AS n FROM pairs GROUP BY cad_id),
res AS (SELECT c.*, CASE WHEN a.present_row IS NOT NULL THEN 'PRESENT' WHEN a.split_row IS NOT NULL THEN 'SPLIT_SUGGESTED'
    WHEN coalesce(a.n, 0) > 0 THEN 'CONFLICT' ELSE 'MISSING' END AS status,
  coalesce(a.present_row, a.split_row) AS matched_row, CAST(coalesce(a.n, 0) AS BIGINT) AS n_same_day
  FROM cad c LEFT JOIN agg a ON c.cad_id = a.cad_id),
resl AS (SELECT r.*, l.location AS matched_loc FROM res r LEFT JOIN lg l ON l.row_idx = r.matched_row)"""


def _reconciled(spark, sf_dir):
    """The reconciliation plan and the log it was made against."""
    cad, log = recon_sides(spark, sf_dir)
    return R.reconcile(cad, log), log


@register("reconcile", f"""{_RECON_SQL}
SELECT cad_id, date, location, status, matched_row, matched_loc, n_same_day FROM resl""")
def reconcile(spark, sf_dir):
    """JOI2 (STR3-STR6 inside): classify every dispatch-like row against the same-date log."""
    res, _ = _reconciled(spark, sf_dir)
    return res.select("cad_id", "date", "location", "status", "matched_row", "matched_loc", "n_same_day")


@register("reconcile_counts", f"""{_RECON_SQL}
SELECT count_if(status = 'PRESENT') AS present, count_if(status = 'SPLIT_SUGGESTED') AS split_suggested,
  count_if(status = 'CONFLICT') AS conflict, count_if(status = 'MISSING') AS missing FROM resl""")
def reconcile_counts(spark, sf_dir):
    """AGG11: zero-filled class counts."""
    res, _ = _reconciled(spark, sf_dir)
    return R.class_counts(res)


@register("reconcile_conflicts", f"""{_RECON_SQL}
SELECT l.date, l.row_idx, l.location FROM lg l WHERE l.date IN (SELECT date FROM resl WHERE status = 'CONFLICT')""")
def reconcile_conflicts(spark, sf_dir):
    """CONFLICT evidence in long form: the same-day log rows (one row each, no pairs)."""
    res, log = _reconciled(spark, sf_dir)
    return R.conflict_candidates(res, log)


def _sql_initial(x):
    toks = (f"list_filter(string_split_regex({S.trim_ws(f'coalesce({x}, {Q(str())})')}, '\\s+'), "
            f"lambda t: t <> '' AND NOT regexp_matches(regexp_replace(t, '\\.+$', ''), '^\\d+$') "
            f"AND NOT suffix(t, '.'))")
    return (f"CASE WHEN len({toks}) >= 2 THEN left({toks}[1], 1) || '. ' || array_to_string(({toks})[2:], ' ') "
            f"ELSE array_to_string({toks}, ' ') END")


@register("proposals", f"""{_RECON_SQL},
prop AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY cad_id) AS seq FROM resl
  WHERE status IN ('MISSING', 'SPLIT_SUGGESTED'))
SELECT cad_id, CASE WHEN date IS NOT NULL THEN strftime(date, '%Y%m%d') || '-' || printf('%03d', seq) ELSE '' END AS event_id,
  date, {S.hhmm('call_s')} AS start_time, {S.hhmm('((call_s + 1800) % 86400)')} AS end_time, 0.5 AS total_time,
  case_no, event_name, location, {_sql_initial('attendee_names')} AS attendees,
  CASE WHEN status = 'MISSING' THEN 'MISSING -> new row'
       ELSE 'SPLIT row ' || CAST(matched_row AS VARCHAR) || ' (' || matched_loc || ') -> this half' END AS reason
FROM prop""")
def proposals(spark, sf_dir):
    """OUT1 + WIN2: paste-ready log rows for MISSING / SPLIT rows, ids numbered per date."""
    res, _ = _reconciled(spark, sf_dir)
    return R.proposals(res)


# ------------------------------------------------------------------ JOI4 by row

_RUNS_SQL = """b AS (SELECT CAST(ts AS DATE) AS date, 'user ' || CAST(user_id AS VARCHAR) AS location, event_type, CAST(floor(value) AS BIGINT) AS v FROM events),
a AS (SELECT CAST(ts AS DATE) AS date, 'user ' || CAST(user_id AS VARCHAR) AS location,
  CASE WHEN event_id % 17 = 0 THEN upper(event_type) ELSE event_type END AS event_type, CAST(floor(value) AS BIGINT) AS v
  FROM events WHERE event_id % 11 <> 0
  UNION ALL SELECT CAST(ts AS DATE), 'user ' || CAST(user_id AS VARCHAR), event_type, CAST(floor(value) AS BIGINT) FROM events WHERE event_id % 23 = 0)"""


def _two_runs(spark, sf_dir):
    """An earlier and a later run derived from every event: rows gone, rewritten and doubled."""
    ev = table(spark, sf_dir, "events", spread=False)
    cols = [F.col("ts").cast("date").alias("date"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("location")]
    v = F.floor("value").cast("long").alias("v")
    before = ev.select(*cols, "event_type", v)
    rewritten = F.when(F.col("event_id") % 17 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type")
    after = (ev.where(F.col("event_id") % 11 != 0).select(*cols, rewritten, v)
               .unionByName(ev.where(F.col("event_id") % 23 == 0).select(*cols, "event_type", v)))
    return before, after


@register("run_change_set", f"""WITH {_RUNS_SQL},
d AS (SELECT date, location, event_type, v, CAST(sum(nb) AS BIGINT) AS n_before, CAST(sum(na) AS BIGINT) AS n_after FROM
  (SELECT *, 1 AS nb, 0 AS na FROM b UNION ALL SELECT *, 0, 1 FROM a) GROUP BY date, location, event_type, v HAVING sum(nb) <> sum(na)),
k AS (SELECT date, location, min(n_after - n_before) < 0 AND max(n_after - n_before) > 0 AS mixed FROM d GROUP BY date, location)
SELECT d.date, d.location, event_type, v, n_before, n_after, n_after - n_before AS delta,
  CASE WHEN mixed THEN 'changed' WHEN n_after > n_before THEN 'inserted' ELSE 'removed' END AS change
FROM d JOIN k ON d.date IS NOT DISTINCT FROM k.date AND d.location IS NOT DISTINCT FROM k.location""")
def run_change_set(spark, sf_dir):
    """JOI4: rows inserted, removed and changed between two runs, by the (date, place) key."""
    before, after = _two_runs(spark, sf_dir)
    out = report.change_set(before, after, ["date", "location"])
    row = F.from_json("row", "event_type string, v long")
    return out.select("date", "location", row["event_type"].alias("event_type"), row["v"].alias("v"),
                      "n_before", "n_after", "delta", "change")


# ------------------------------------------------------------------ WIN2 beside ids in use

_TAKEN_SQL = """taken AS (SELECT DISTINCT date, 1 + (row_idx * 7) % 60 AS number FROM lg WHERE date IS NOT NULL AND row_idx % 3 <> 1)"""


@register("proposal_ids_beside_log", f"""{_RECON_SQL}, {_TAKEN_SQL},
prop AS (SELECT cad_id, date, row_number() OVER (PARTITION BY date ORDER BY cad_id) AS seq FROM resl
  WHERE status IN ('MISSING', 'SPLIT_SUGGESTED')),
days AS (SELECT date, count(*) AS n FROM prop WHERE date IS NOT NULL GROUP BY date),
free AS (SELECT date, number, row_number() OVER (PARTITION BY date ORDER BY number) AS seq FROM
  (SELECT date, unnest(range(1, n + 62)) AS number FROM days) ANTI JOIN taken USING (date, number))
SELECT cad_id, prop.date, CASE WHEN prop.date IS NULL THEN '' ELSE strftime(prop.date, '%Y%m%d') || '-' || printf('%03d', number) END AS event_id
FROM prop LEFT JOIN free ON prop.date = free.date AND prop.seq = free.seq""")
def proposal_ids_beside_log(spark, sf_dir):
    """WIN2 / OUT1: proposal ids take the free numbers of a date in which the log uses up to 60."""
    res, log = _reconciled(spark, sf_dir)
    number = 1 + (F.col("row_idx") * 7) % 60
    ids = log.where("date IS NOT NULL AND row_idx % 3 <> 1").select(
        F.format_string("%s-%03d", F.date_format("date", "yyyyMMdd"), number).alias("event_id"))
    return R.proposals(res, taken=ids).select("cad_id", "date", "event_id")


# ------------------------------------------------------------------ SRC5 / VAL1 contract

@register("dispatch_contract", """SELECT event_id, concat_ws(',', CASE WHEN event_id % 7 = 6 THEN 'blank:Squad' END,
  CASE WHEN event_id % 10 = 0 THEN 'blank:Time In Display' END, CASE WHEN user_id % 3 = 2 THEN 'number:St Number' END) AS reasons
FROM events WHERE event_id % 7 = 6 OR event_id % 10 = 0 OR user_id % 3 = 2""")
def dispatch_contract(spark, sf_dir):
    """SRC5 / VAL1: rows of the dispatch export that a contract rejects, with the reasons."""
    from ..operators import contract as C
    from .driver_tables import cad_raw
    from ..operators.standardize import DISPATCH_COLUMNS
    rules = C.Contract(required=DISPATCH_COLUMNS, not_blank=("Squad", "Time In Display"),
                       kinds={"Time In Display": "clock", "Time of Call": "date", "St Number": "number"})
    marked = C.with_reasons(cad_raw(spark, sf_dir), rules, "dispatch")
    return marked.where(F.size(C.REASONS) > 0).select("event_id", F.concat_ws(",", C.REASONS).alias("reasons"))
