"""Quality, validation and aggregate-report queries (VAL3, VAL4, QLT1-QLT9,
QLT11, AGG3, AGG4, AGG6-AGG9, WIN1, SRT2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..functions.text import blank_to_null
from ..operators import quality, report
from ..sources.files import count_tokens
from . import oracle_sql as S
from .catalog import register
from .driver_tables import PROCESSED_DATE, table
from .feed import build_feed

Q = S.q
AS_OF_YEAR = int(PROCESSED_DATE[:4])
QA_FIELDS = ("event_name", "date", "duration_hours", "attendee_count", "office", "division", "location")


# ------------------------------------------------------------------ derived raw text frame

def qa_frame(spark, sf_dir):
    """Raw-text event cells derived from every order (blanks, junk and out-of-range values)."""
    o = table(spark, sf_dir, "orders")
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    cols = {
        "event_name": F.when(k % 7 != 0, F.col("o_orderpriority")),
        "date": (F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
                 .when(k % 4 == 1, F.date_format(d, "MM/dd/yyyy"))
                 .when(k % 4 == 2, F.when(k % 8 == 2, F.lit("invalid_date"))
                       .otherwise(F.concat(F.lit("2024-05-0"), (1 + k % 9).cast("string"))))),
        "duration_hours": (F.when(k % 5 == 0, F.lit("2.0")).when(k % 5 == 1, F.lit("-1"))
                           .when(k % 5 == 2, F.lit("25")).when(k % 5 == 3, F.lit("abc"))),
        "attendee_count": (F.when(k % 6 == 0, F.lit("1500")).when(k % 6 == 1, F.lit("-2"))
                           .when(k % 6 == 2, F.lit("x")).otherwise((c % 50).cast("string"))),
        "office": F.when(k % 11 != 0, F.col("o_orderstatus")),
        "division": F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 9 == 1, F.lit(""))
                     .otherwise(F.col("o_orderpriority")),
        "location": F.when(k % 10 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Site "), (c % 50).cast("string"))),
    }
    return o.select(k, *[F.when(k % 97 != 0, v).alias(n) for n, v in cols.items()])


_QA_SQL = """qa AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END END AS event_name,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 2 THEN CASE WHEN o_orderkey % 8 = 2 THEN 'invalid_date' ELSE '2024-05-0' || CAST(1 + o_orderkey % 9 AS VARCHAR) END
    END END AS date,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE o_orderkey % 5 WHEN 0 THEN '2.0' WHEN 1 THEN '-1' WHEN 2 THEN '25'
    WHEN 3 THEN 'abc' END END AS duration_hours,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE o_orderkey % 6 WHEN 0 THEN '1500' WHEN 1 THEN '-2' WHEN 2 THEN 'x'
    ELSE CAST(o_custkey % 50 AS VARCHAR) END END AS attendee_count,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END END AS office,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN ''
    ELSE o_orderpriority END END AS division,
  CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN '  '
    ELSE 'Site ' || CAST(o_custkey % 50 AS VARCHAR) END END AS location
  FROM orders)"""


def _pct(part, whole):
    return f"round_even(({part}) * 100.0 / ({whole}), 1)"


_QS_SQL = f"""WITH {_QA_SQL},
p AS (SELECT *, {S.parse_date(S.m2n('date'))} AS d_parsed, {S.to_double('duration_hours')} AS u,
  {S.to_double('attendee_count')} AS cnt FROM qa),
a AS (SELECT count(*) AS n,
  count_if(event_name IS NULL) + count_if(date IS NULL) + count_if(office IS NULL) + count_if(division IS NULL) AS miss,
  count(date) AS d_nn, count(d_parsed) AS d_ok,
  count_if(d_parsed IS NOT NULL AND NOT (year(d_parsed) BETWEEN 2020 AND {AS_OF_YEAR + 1})) AS d_bad,
  count(duration_hours) AS u_nn, count(u) AS u_num, count_if(u IS NOT NULL AND NOT (u BETWEEN 0 AND 24)) AS u_bad,
  count(attendee_count) AS c_nn, count_if(cnt IS NOT NULL AND cnt >= 0) AS c_okn, count(cnt) AS c_num,
  count_if(cnt IS NOT NULL AND NOT (cnt BETWEEN 0 AND 1000)) AS c_bad FROM p),
s AS (SELECT CASE WHEN n > 0 THEN {_pct('n * 4 - miss', 'n * 4')} ELSE 0.0 END AS completeness,
  d_nn + u_nn + c_nn AS checks, (u_nn - u_num) + (c_nn - c_okn) AS issues,
  d_ok + u_num + c_num AS acc_total, d_bad + u_bad + c_bad AS acc_bad FROM a),
g AS (SELECT count(*) AS k FROM qa GROUP BY event_name, date, office, division),
u AS (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_count, coalesce(sum(k), 0) AS r FROM g),
sc AS (SELECT completeness,
  CASE WHEN checks > 0 THEN {_pct('checks - issues', 'checks')} ELSE 100.0 END AS consistency,
  CASE WHEN acc_total > 0 THEN {_pct('acc_total - acc_bad', 'acc_total')} ELSE 100.0 END AS accuracy,
  CAST(issues AS BIGINT) AS format_issues, CAST(acc_bad AS BIGINT) AS logical_issues, duplicate_count,
  CASE WHEN r > 0 THEN {_pct('r - duplicate_count', 'r')} ELSE 100.0 END AS uniqueness FROM s, u)
SELECT *, CASE WHEN (completeness + consistency + accuracy + uniqueness) / 4.0 >= 90 THEN {Q(quality.QUALITY_LABELS[0][1])}
  WHEN (completeness + consistency + accuracy + uniqueness) / 4.0 >= 80 THEN {Q(quality.QUALITY_LABELS[1][1])}
  WHEN (completeness + consistency + accuracy + uniqueness) / 4.0 >= 70 THEN {Q(quality.QUALITY_LABELS[2][1])}
  ELSE {Q(quality.QUALITY_LABELS[3][1])} END AS label,
  round_even((completeness + consistency + accuracy + uniqueness) / 4.0, 1) AS overall FROM sc"""


@register("quality_scores", _QS_SQL)
def quality_scores(spark, sf_dir):
    """QLT2-QLT6: completeness, consistency, accuracy, uniqueness, overall, label."""
    return quality.quality_scores(qa_frame(spark, sf_dir), AS_OF_YEAR)


_ISSUES_SQL = f"""WITH {_QA_SQL},
i AS (SELECT o_orderkey,
  ({' AND '.join(f'{S.b2n(c)} IS NULL' for c in QA_FIELDS)}) AS empty,
  list_filter([{', '.join(f"CASE WHEN {S.b2n(c)} IS NULL THEN {Q(c)} END" for c in ('event_name', 'date'))}],
    lambda x: x IS NOT NULL) AS missing FROM qa),
r AS (SELECT o_orderkey, CASE WHEN empty THEN 'empty' WHEN len(missing) = 0 THEN 'valid' ELSE 'invalid' END AS status,
  CASE WHEN empty THEN '' ELSE array_to_string(missing, ',') END AS missing_fields FROM i)"""


@register("row_issues", f"""{_ISSUES_SQL}
SELECT * FROM r""")
def row_issues(spark, sf_dir):
    """VAL3 per row: empty / valid / invalid with the blank required fields."""
    f = quality.row_issues(qa_frame(spark, sf_dir), ["event_name", "date"], list(QA_FIELDS))
    return f.select("o_orderkey", "status", "missing_fields")


@register("row_issue_summary", f"""{_ISSUES_SQL}
SELECT count(*) AS rows, count_if(status = 'empty') AS empty_rows, count_if(status = 'valid') AS valid_rows,
  count_if(status = 'invalid') AS invalid_rows,
  CASE WHEN count_if(status <> 'empty') > 0 THEN {_pct("count_if(status = 'valid')", "count_if(status <> 'empty')")}
    ELSE 0.0 END AS valid_pct FROM r""")
def row_issue_summary(spark, sf_dir):
    """VAL3 counts and valid percentage."""
    return quality.row_issue_summary(quality.row_issues(qa_frame(spark, sf_dir), ["event_name", "date"],
                                                        list(QA_FIELDS)))


@register("date_type_check", f"""WITH {_QA_SQL}
SELECT count_if({S.b2n('date')} IS NOT NULL AND {S.parse_date(S.m2n('date'))} IS NULL) AS violations,
  count_if({S.b2n('date')} IS NOT NULL AND {S.parse_date(S.m2n('date'))} IS NULL) = 0 AS conforms FROM qa""")
def date_type_check(spark, sf_dir):
    """VAL4: every non-blank date cell must parse."""
    f = qa_frame(spark, sf_dir)
    v = quality.type_violations(F.col("date"), dates.parse_date("date"))
    return f.agg(v.alias("violations")).withColumn("conforms", F.col("violations") == 0)


_F = S.feed_ctes()


@register("combined_score", f"""{_F}
SELECT count(*) AS rows, CAST(count_if(event_name IS NULL) + count_if(date IS NULL) + count_if(office IS NULL)
  + count_if(division IS NULL) AS BIGINT) AS missing_critical,
  CASE WHEN count(*) > 0 THEN {_pct('count(*) * 4 - (count_if(event_name IS NULL) + count_if(date IS NULL) + count_if(office IS NULL) + count_if(division IS NULL))', 'count(*) * 4')}
    ELSE 0.0 END AS quality_score FROM feed""")
def combined_score(spark, sf_dir):
    """QLT1 on the combined feed."""
    return quality.combined_score(build_feed(spark, sf_dir).feed)


# ------------------------------------------------------------------ QLT7/QLT8/SRT2

_CUSTOMER = (("c_custkey", "integer"), ("c_name", "text"), ("c_nationkey", "integer"), ("c_acctbal", "float"),
             ("c_mktsegment", "text"))
_LINEITEM = (("l_orderkey", "integer"), ("l_partkey", "integer"), ("l_suppkey", "integer"),
             ("l_linenumber", "integer"), ("l_quantity", "float"), ("l_extendedprice", "float"),
             ("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "text"), ("l_linestatus", "text"),
             ("l_shipdate", "datetime"))


def _profile_sql(tbl, cols):
    parts = []
    for i, (c, dt) in enumerate(cols):
        text = dt == "text"
        dl = f"count_if({S.parse_date(S.m2n(c))} IS NOT NULL)" if text else "0"
        mn = f"min({c})" if text else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {i} AS position, {Q(c)} AS \"column\", {Q(dt)} AS dtype, count({c}) AS non_null, "
                     f"CASE WHEN count(*) > 0 THEN {_pct(f'count({c})', 'count(*)')} ELSE 0.0 END AS pct_non_null, "
                     f"count(DISTINCT {c}) AS n_distinct, CAST({dl} AS BIGINT) AS date_like, {mn} AS min_text "
                     f"FROM {tbl}")
    return " UNION ALL ".join(parts)


@register("column_profile", _profile_sql("customer", _CUSTOMER))
def column_profile(spark, sf_dir):
    """QLT7: one-pass column profile of ``customer`` in long form."""
    return quality.column_profile(table(spark, sf_dir, "customer"))


@register("top_complete_columns", f"""SELECT * FROM ({_profile_sql('lineitem', _LINEITEM)})
ORDER BY pct_non_null DESC, position LIMIT 10""")
def top_complete_columns(spark, sf_dir):
    """SRT2: the ten most complete columns of ``lineitem`` (the limit is the report)."""
    p = quality.column_profile(table(spark, sf_dir, "lineitem"))
    return p.orderBy(F.col("pct_non_null").desc(), F.col("position")).limit(10)


@register("frame_summary", """WITH g AS (SELECT count(*) AS k FROM lineitem GROUP BY ALL_COLUMNS_PLACEHOLDER)
SELECT (SELECT count(*) FROM lineitem) AS rows, 11 AS columns,
  (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL AND l_partkey IS NULL AND l_suppkey IS NULL
    AND l_linenumber IS NULL AND l_quantity IS NULL AND l_extendedprice IS NULL AND l_discount IS NULL
    AND l_tax IS NULL AND l_returnflag IS NULL AND l_linestatus IS NULL AND l_shipdate IS NULL) AS all_null_rows,
  (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM g) AS duplicate_rows""".replace(
    "ALL_COLUMNS_PLACEHOLDER", ", ".join(c for c, _ in _LINEITEM)))
def frame_summary(spark, sf_dir):
    """QLT8: rows, columns, all-NULL rows, duplicate rows of ``lineitem``."""
    return quality.frame_summary(table(spark, sf_dir, "lineitem"))


# ------------------------------------------------------------------ QLT9

_EXPORT_NAMES = ("doc_id", "text: body", "con", "Source (Hours)", "n|chars")


@register("export_check", """WITH names AS (SELECT unnest(['doc_id', 'text: body', 'con', 'Source (Hours)', 'n|chars']) AS c),
bad AS (SELECT count(*) AS k FROM names WHERE regexp_matches(c, '[<>:"|?*]') OR upper(c) IN ('CON', 'PRN', 'AUX', 'NUL')
  OR length(c) > 128),
a AS (SELECT count(*) AS rows, coalesce(greatest(max(length(text)), max(length(lang)), max(length(source))), 0) AS max_text_length,
  count_if(length(text) > 32767) + count_if(length(lang) > 32767) + count_if(length(source) > 32767) AS over_cells,
  CAST(coalesce(max(length(text)), 0) > 32767 AS INT) + CAST(coalesce(max(length(lang)), 0) > 32767 AS INT)
    + CAST(coalesce(max(length(source)), 0) > 32767 AS INT) AS over_columns FROM documents),
s AS (SELECT a.*, bad.k, 100.0 * (5 - over_columns) / 5 AS type_score FROM a, bad),
r AS (SELECT *, 25.0 * (CAST(k = 0 AS INT) + CAST(type_score >= 95 AS INT) + CAST(over_cells = 0 AS INT)
  + CAST(rows <= 1000000 AS INT)) AS score FROM s)
SELECT rows, 5 AS columns, max_text_length, CAST(over_cells AS BIGINT) AS over_limit_cells,
  CAST(k AS INTEGER) AS bad_column_names, type_score, score,
  CASE WHEN score >= 95 THEN 'compatible' WHEN score >= 85 THEN 'mostly compatible'
    WHEN score >= 70 THEN 'needs work' ELSE 'incompatible' END AS label FROM r""")
def export_check(spark, sf_dir):
    """QLT9 (+STR15): export compatibility of ``documents`` under column names of which three
    break a rule (names, text length limit, types, size)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return quality.export_check(docs.toDF(*_EXPORT_NAMES))


# ------------------------------------------------------------------ QLT11

@register("log_error_count", """SELECT CAST(coalesce(sum((length(text) - length(replace(text, 'the', ''))) / 3), 0) AS BIGINT) AS token_hits,
  count(*) AS lines, coalesce(sum((length(text) - length(replace(text, 'the', ''))) / 3), 0) > 10 AS alert FROM conversations""")
def log_error_count(spark, sf_dir):
    """QLT11: occurrences of a token over every conversation line, with the alert flag."""
    return count_tokens(table(spark, sf_dir, "conversations"), "text", "the")


@register("quality_gate", f"SELECT q.*, overall >= 75.0 AS passed FROM ({_QS_SQL}) q")
def quality_gate(spark, sf_dir):
    """QLT10: the run's scores with the gate at 75."""
    return quality.quality_gate(quality.quality_scores(qa_frame(spark, sf_dir), AS_OF_YEAR))


@register("distinct_listing", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def distinct_listing(spark, sf_dir):
    """AGG6: every source of ``documents`` with its rows."""
    return report.distinct_listing(table(spark, sf_dir, "documents"), "source")


@register("crosstab_full", """WITH g AS (SELECT conv_id, role, grouping(conv_id) AS gr, grouping(role) AS gc, count(*) AS k
  FROM conversations GROUP BY CUBE (conv_id, role))
SELECT CASE WHEN r.gr = 1 THEN 'All' ELSE CAST(r.conv_id AS VARCHAR) END AS conv_id, CASE WHEN s.gc = 1 THEN 'All' ELSE s.role END AS role,
  CAST(2 * r.gr + s.gc AS INTEGER) AS margin, coalesce(g.k, 0) AS n
FROM (SELECT DISTINCT conv_id, gr FROM g) r CROSS JOIN (SELECT DISTINCT role, gc FROM g) s
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND g.role IS NOT DISTINCT FROM s.role AND g.gr = r.gr AND g.gc = s.gc""")
def crosstab_full(spark, sf_dir):
    """AGG4 with zero cells: turns of every conversation by role (most have no system turn)."""
    return report.crosstab_full(table(spark, sf_dir, "conversations"), "conv_id", "role")


@register("office_substring_rows", f"""{_F}
SELECT date, event_name, location, office, data_source FROM feed WHERE contains(office, 'Engagement')""")
def office_substring_rows(spark, sf_dir):
    """FLT7: the rows whose office contains a substring."""
    f = build_feed(spark, sf_dir).feed
    return f.where(F.col("office").contains("Engagement")).select("date", "event_name", "location", "office", "data_source")


@register("value_share", """SELECT event_type, count(*) AS n,
  round_even(count(*) * 100.0 / (SELECT count(*) FROM events), 2) AS pct FROM events GROUP BY event_type""")
def value_share(spark, sf_dir):
    """AGG3: event-type counts with percent of total."""
    return report.value_share(table(spark, sf_dir, "events"), "event_type", scale=2)


@register("crosstab_margins", """WITH t AS (SELECT event_type, 'seg' || CAST(user_id % 4 AS VARCHAR) AS segment FROM events)
SELECT CASE WHEN grouping(event_type) = 1 THEN 'All' ELSE event_type END AS event_type,
  CASE WHEN grouping(segment) = 1 THEN 'All' ELSE segment END AS segment,
  CAST(2 * grouping(event_type) + grouping(segment) AS INTEGER) AS margin, count(*) AS n
FROM t GROUP BY CUBE (event_type, segment)""")
def crosstab_margins(spark, sf_dir):
    """AGG4: event type x user segment counts with ``All`` margins (one cube pass)."""
    ev = table(spark, sf_dir, "events").select(
        "event_type", F.concat(F.lit("seg"), (F.col("user_id") % 4).cast("string")).alias("segment"))
    return report.crosstab_margins(ev, "event_type", "segment")


@register("distinct_values", """SELECT count(DISTINCT user_id) AS n_distinct, CAST(min(user_id) AS VARCHAR) AS min_value,
  CAST(max(user_id) AS VARCHAR) AS max_value FROM events""")
def distinct_values(spark, sf_dir):
    """AGG6: distinct count and range of ``events.user_id``."""
    return report.distinct_values(table(spark, sf_dir, "events"), "user_id")


def _describe_sql(cols):
    def one(c):
        s1 = f"CAST(sum(CAST({c} AS DECIMAL(38, 4))) AS DOUBLE)"
        s2 = f"CAST(sum(CAST({c} AS DECIMAL(38, 8)) * CAST({c} AS DECIMAL(38, 8))) AS DOUBLE)"
        n = f"count({c})"
        return (f"SELECT {Q(c)} AS \"column\", {n} AS count, round_even({s1} / {n}, 6) AS mean, "
                f"round_even(CASE WHEN {n} > 1 THEN sqrt(greatest(({s2} - {s1} * {s1} / {n}) / ({n} - 1), 0.0)) END, 6)"
                f" AS std, min({c}) AS min, round_even(quantile_cont({c}, 0.25), 6) AS p25, "
                f"round_even(quantile_cont({c}, 0.5), 6) AS p50, round_even(quantile_cont({c}, 0.75), 6) AS p75, "
                f"max({c}) AS max FROM lineitem")
    return " UNION ALL ".join(one(c) for c in cols)


_DESC_COLS = ("l_quantity", "l_extendedprice", "l_discount")


@register("describe_numeric", _describe_sql(_DESC_COLS))
def describe_numeric(spark, sf_dir):
    """AGG7: count, mean, std, min, quartiles, max of three ``lineitem`` measures."""
    d = report.describe_numeric(table(spark, sf_dir, "lineitem"), _DESC_COLS,
                                tiebreak=("l_orderkey", "l_linenumber", "l_partkey"))
    r6 = lambda c: numbers.round_half_even(F.col(c), 6)
    return d.select("column", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                    r6("p25").alias("p25"), r6("p50").alias("p50"), r6("p75").alias("p75"), "max")


@register("duplicate_groups", """SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    """AGG8: exact-duplicate document texts (surfaced, not removed)."""
    d = table(spark, sf_dir, "documents")
    g = report.duplicate_groups(d, ["text"])
    return g.select(F.md5("text").alias("text_md5"), "n")


@register("duplicate_count", """SELECT CAST(sum(k - 1) AS BIGINT) AS duplicate_rows, CAST(sum(k) AS BIGINT) AS rows
FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_partkey)""")
def duplicate_count(spark, sf_dir):
    """AGG9: line items repeating an earlier (order, part) pair."""
    return report.duplicate_row_count(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@register("first_n_per_group", """SELECT o_orderpriority, o_orderkey, o_orderdate, rank_in_group FROM (
  SELECT o_orderpriority, o_orderkey, o_orderdate,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rank_in_group FROM orders)
WHERE rank_in_group <= 2""")
def first_n_per_group(spark, sf_dir):
    """WIN1: the first two orders of every priority (explicit total order)."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return report.first_n_per_group(o, "o_orderpriority", ["o_orderdate", "o_orderkey"], 2)


@register("office_substring_audit", f"""{_F}
SELECT office, count(*) AS n FROM feed WHERE contains(office, 'Engagement') GROUP BY office""")
def office_substring_audit(spark, sf_dir):
    """FLT7: rows whose office contains a substring, counted per office."""
    f = build_feed(spark, sf_dir).feed
    return f.where(F.col("office").contains("Engagement")).groupBy("office").agg(F.count(F.lit(1)).alias("n"))


@register("blank_rows", f"""WITH {_QA_SQL}
SELECT count_if({' AND '.join(f'{S.b2n(c)} IS NULL' for c in QA_FIELDS)}) AS blank_rows, count(*) AS rows FROM qa""")
def blank_rows(spark, sf_dir):
    """FLT8 / FLT9: completely blank rows (NULL or whitespace in every cell)."""
    from ..operators.schema import all_blank
    f = qa_frame(spark, sf_dir)
    return f.agg(F.count_if(all_blank(*QA_FIELDS)).alias("blank_rows"), F.count(F.lit(1)).alias("rows"))


_ = blank_to_null  # re-exported helper used by callers of this module


@register("export_roundtrip", """SELECT count(*) AS rows_out, count(*) AS rows_in, true AS same_columns,
  true AS same_nulls, CAST(0 AS BIGINT) AS rows_lost, CAST(0 AS BIGINT) AS rows_added, true AS ok FROM documents""")
def export_roundtrip(spark, sf_dir):
    """SNK6: ``documents`` written as CSV into the shared checkpoint folder and read
    back; shape, names, NULL counts and content must survive (the oracle is the
    lossless outcome).  The write happens when the query is built."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources.sinks import roundtrip_check
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip/documents-{uuid.uuid4().hex}"
    return roundtrip_check(table(spark, sf_dir, "documents"), path, fmt="csv")


@register("export_validated", """WITH a AS (SELECT count(*) AS rows, count_if(length(text) > 32767) + count_if(length(lang) > 32767)
  + count_if(length(source) > 32767) AS over_cells, CAST(coalesce(max(length(text)), 0) > 32767 AS INT)
  + CAST(coalesce(max(length(lang)), 0) > 32767 AS INT) + CAST(coalesce(max(length(source)), 0) > 32767 AS INT) AS over_columns FROM documents),
s AS (SELECT rows, 100.0 * (5 - over_columns) / 5 AS type_score, over_cells = 0 AND rows <= 1000000 AS fits FROM a),
r AS (SELECT *, 25.0 * (1 + CAST(type_score >= 95 AS INT) + 1 + CAST(fits AS INT)) AS score FROM s)
SELECT rows, 5 AS columns, CAST(0 AS INTEGER) AS bad_column_names, type_score, true AS round_trip, fits AS fits_a_sheet, score,
  CASE WHEN score >= 95 THEN 'compatible' WHEN score >= 85 THEN 'mostly compatible' WHEN score >= 70 THEN 'needs work'
    ELSE 'incompatible' END AS label FROM r""")
def export_validated(spark, sf_dir):
    """QLT9 with SNK6: ``documents`` through the four export checks, one of them the round trip by
    digest (the oracle is the lossless outcome)."""
    import uuid

    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip/validated-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return quality.export_validated(docs, path)


@register("column_sketch", """WITH l AS (SELECT * FROM customer)
SELECT * FROM (
  SELECT 0 AS position, 'c_custkey' AS "column", count(c_custkey) AS non_null, CAST(0 AS BIGINT) AS numeric_like, CAST(0 AS BIGINT) AS date_like, false AS numeric_text, CAST(NULL AS INTEGER) AS longest FROM l
  UNION ALL SELECT 1, 'nation', count(c_nationkey), count(c_nationkey), 0, count(c_nationkey) > 0, CAST(max(length(CAST(c_nationkey AS VARCHAR))) AS INTEGER) FROM l
  UNION ALL SELECT 2, 'mixed', count(*), count_if(c_custkey % 2 = 0), count_if(c_custkey % 2 = 1), false,
    CAST(max(CASE WHEN c_custkey % 2 = 0 THEN length(CAST(c_custkey AS VARCHAR)) ELSE 10 END) AS INTEGER) FROM l)""")
def column_sketch(spark, sf_dir):
    """QLT7 by sketches: types, numbers and dates found in the text of ``customer`` (exact figures; the
    estimates are tested against exact counts)."""
    c = F.col("c_custkey")
    cu = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation"),
        F.when(c % 2 == 0, c.cast("string")).otherwise(F.lit("2024-05-17")).alias("mixed"))
    return quality.column_sketch(cu).select("position", "column", "non_null", "numeric_like", "date_like", "numeric_text", "longest")


_LAYOUT_SQL = """WITH o AS (SELECT o_orderkey, o_custkey % 12 AS file, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, file, CASE file % 3 WHEN 0 THEN 'day first' WHEN 1 THEN 'month first' ELSE 'tied' END AS layout,
  CASE WHEN file % 3 = 2 AND day(d) <= 12 AND day(d) <> month(d) THEN NULL ELSE d END AS parsed_date FROM o"""


@register("date_layouts", _LAYOUT_SQL)
def date_layouts(spark, sf_dir):
    """DAT1: order dates as twelve files write them (day first, month first, or never telling which)."""
    from ..operators import layouts
    file, d = F.col("o_custkey") % 12, F.col("o_orderdate").cast("date")
    cell = (F.when(file % 3 == 0, F.date_format(d, "dd/MM/yyyy")).when(file % 3 == 1, F.date_format(d, "M/d/yyyy"))
            .when(F.dayofmonth(d) <= 12, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd")))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", file.alias("file"), cell.alias("Date"))
    return layouts.parse_by_layout(raw, ["file"], "Date").select("o_orderkey", "file", "layout", "parsed_date")


@register("sheet_by_header", """SELECT c_custkey, c_name AS "Name", CASE WHEN c_nationkey % 5 <> 4 THEN c_mktsegment END AS "Segment"
FROM customer""")
def sheet_by_header(spark, sf_dir):
    """SRC1: decoded sheet rows of ``customer``, one sheet a nation, columns in other places in every
    sheet, read by each sheet's own header."""
    from ..sources import workbook
    n, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")

    def laid(a, b, c):
        blank = F.lit(None).cast("string")
        return (F.when(n % 5 == 0, F.array(a, b, c)).when(n % 5 == 1, F.array(c, blank, b, a)).when(n % 5 == 2, F.array(b, a, c))
                .when(n % 5 == 3, F.array(F.lit("x"), c, a, b)).otherwise(F.array(b, a)))
    cu = table(spark, sf_dir, "customer")
    sheet = [F.lit("book").alias("file"), n.cast("string").alias("sheet")]
    body = cu.select(*sheet, (F.col("c_custkey") + 10).cast("int").alias("row_no"), laid(key, F.col("c_name"), F.col("c_mktsegment")).alias("cells"))
    heads = cu.groupBy("c_nationkey").count().select(*sheet, (1 + n % 3).cast("int").alias("row_no"),
                                                     laid(F.lit("Key "), F.lit("Name"), F.lit("Segment")).alias("cells"))
    rows = body.unionByName(heads).withColumn("error", F.lit(None).cast("string"))
    out = workbook.by_header(rows, ["Key", "Name", "Segment"])
    return out.select(F.col("Key").cast("long").alias("c_custkey"), "Name", "Segment")
