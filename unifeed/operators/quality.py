"""Quality and validation operators (VAL3, VAL4, QLT1-QLT9, AGG9 use).

Every score is computed by one aggregation pass (plus one grouping pass for
uniqueness); nothing is collected.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..functions.numbers import pct, round_half_even
from ..functions.text import blank_to_null, to_double

CRITICAL_FIELDS = ("event_name", "date", "office", "division")
# Quality labels by overall score (QLT6).
QUALITY_LABELS = ((90, "Excellent data quality - ready for production"),
                  (80, "Good data quality - minor issues to address"),
                  (70, "Fair data quality - review and fix critical issues"),
                  (None, "Poor data quality - major cleanup required before use"))
# Export limits of the BI tool (QLT9).
MAX_TEXT_LENGTH = 32767
MAX_ROWS = 1_000_000
MAX_COLUMNS = 16_000
MAX_NAME_LENGTH = 128
FORBIDDEN_NAME_CHARS = ("<", ">", ":", '"', "|", "?", "*")
RESERVED_NAMES = ("CON", "PRN", "AUX", "NUL")
# Header keywords that mark event-related columns (STR16).
EVENT_HEADER_KEYWORDS = ("event", "name", "program", "activity", "date", "time", "location", "venue",
                         "member", "staff", "attend")
# Default minimum quality score of a run (QLT10).
MIN_QUALITY_SCORE = 75.0


def combined_score(df: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """QLT1: ``(N*k - nulls) / (N*k) * 100`` over the critical fields; a field the
    frame lacks contributes no nulls; blanks are not nulls.  Also reports N and nulls."""
    present = [f for f in fields if f in df.columns]
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(f).isNull()) for f in present], F.lit(0))
    n = F.count(F.lit(1))
    total = n * len(fields)
    return df.agg(n.alias("rows"), nulls.cast("long").alias("missing_critical"),
                  pct(total - nulls, total).alias("quality_score"))


def quality_scores(df: DataFrame, as_of_year: int, fields: Sequence[str] = CRITICAL_FIELDS,
                   date_col: str = "date", duration_col: str = "duration_hours",
                   count_col: str = "attendee_count", date_kinds: str = "type") -> DataFrame:
    """QLT2-QLT6 on a frame of raw text cells: completeness, consistency,
    accuracy, uniqueness, overall and label -- one row.

    * completeness: NULL cells over the critical fields; an absent field counts
      as all missing; an empty frame scores 0.
    * consistency: dates whose kind is in the minority -- ``date_kinds="type"``
      (the reference: the cell type; one typed or one text column has a single
      kind) or ``"parse"`` (parseable date vs other text) --, durations that
      are not numbers, counts that are not non-negative numbers.
    * accuracy: numeric durations outside [0, 24], counts outside [0, 1000],
      parseable dates with year outside [2020, as_of_year + 1].
    * uniqueness: rows repeating an earlier row on the available key fields.
    """
    n = F.count(F.lit(1))
    miss = reduce(lambda a, b: a + b,
                  [F.count_if(F.col(f).isNull()) if f in df.columns else n for f in fields], F.lit(0))
    cells = n * len(fields)
    completeness = F.when(n > 0, pct(cells - miss, cells)).otherwise(F.lit(0.0))

    cols = {}
    checks = F.lit(0).cast("long")
    issues = F.lit(0).cast("long")
    acc_total = F.lit(0).cast("long")
    acc_bad = F.lit(0).cast("long")
    if date_col in df.columns:
        raw = F.col(date_col).cast("string")
        parsed = dates.parse_date(raw)
        cols["_d_nn"] = F.count_if(raw.isNotNull())
        cols["_d_ok"] = F.count_if(parsed.isNotNull())
        year = F.year(parsed)
        cols["_d_bad"] = F.count_if(parsed.isNotNull() & ~year.between(2020, as_of_year + 1))
    if duration_col in df.columns:
        raw = F.col(duration_col).cast("string")
        v = to_double(raw)
        cols["_u_nn"] = F.count_if(raw.isNotNull())
        cols["_u_num"] = F.count_if(v.isNotNull())
        cols["_u_bad"] = F.count_if(v.isNotNull() & ~v.between(0, 24))
    if count_col in df.columns:
        raw = F.col(count_col).cast("string")
        v = to_double(raw)
        cols["_c_nn"] = F.count_if(raw.isNotNull())
        cols["_c_okn"] = F.count_if(v.isNotNull() & (v >= 0))
        cols["_c_num"] = F.count_if(v.isNotNull())
        cols["_c_bad"] = F.count_if(v.isNotNull() & ~v.between(0, 1000))
    agg = df.agg(n.alias("_n"), miss.alias("_miss"), completeness.alias("completeness"),
                 *[c.alias(k) for k, c in cols.items()])
    c = F.col
    if date_col in df.columns:
        checks = checks + c("_d_nn")
        if date_kinds == "parse":
            issues = issues + F.least(c("_d_ok"), c("_d_nn") - c("_d_ok"))
        acc_total = acc_total + c("_d_ok")
        acc_bad = acc_bad + c("_d_bad")
    if duration_col in df.columns:
        checks = checks + c("_u_nn")
        issues = issues + (c("_u_nn") - c("_u_num"))
        acc_total = acc_total + c("_u_num")
        acc_bad = acc_bad + c("_u_bad")
    if count_col in df.columns:
        checks = checks + c("_c_nn")
        issues = issues + (c("_c_nn") - c("_c_okn"))
        acc_total = acc_total + c("_c_num")
        acc_bad = acc_bad + c("_c_bad")
    consistency = F.when(checks > 0, pct(checks - issues, checks)).otherwise(F.lit(100.0))
    accuracy = F.when(acc_total > 0, pct(acc_total - acc_bad, acc_total)).otherwise(F.lit(100.0))
    keys = [f for f in fields if f in df.columns]
    if keys:
        # repeated key tuples, as a scalar subquery over one grouping pass
        dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k")) \
            .agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long")).scalar()
    else:
        dup = F.lit(0).cast("long")
    uniqueness = F.when(c("_n") > 0, pct(c("_n") - dup, c("_n"))).otherwise(F.lit(100.0))
    j = agg.select("completeness", consistency.alias("consistency"), accuracy.alias("accuracy"),
                   issues.cast("long").alias("format_issues"), acc_bad.cast("long").alias("logical_issues"),
                   dup.alias("duplicate_count"), uniqueness.alias("uniqueness"))
    overall = (F.col("completeness") + F.col("consistency") + F.col("accuracy") + F.col("uniqueness")) / 4.0
    ov = round_half_even(overall, 1)
    return j.withColumn("label", quality_label(overall)).withColumn("overall", ov)


def quality_label(score: Column) -> Column:
    """QLT6 label."""
    out = None
    for bound, text in QUALITY_LABELS:
        if bound is None:
            out = out.otherwise(F.lit(text))
        else:
            out = F.when(score >= bound, F.lit(text)) if out is None else out.when(score >= bound, F.lit(text))
    return out


def row_issues(df: DataFrame, required: Sequence[str], check_cols: Sequence[str] | None = None) -> DataFrame:
    """VAL3: per row -- ``empty`` (every checked cell blank), ``valid``, or
    ``invalid`` with the comma-joined list of blank required fields."""
    check_cols = list(check_cols or df.columns)
    empty = reduce(lambda a, b: a & b, [blank_to_null(F.col(f"`{c}`")).isNull() for c in check_cols])
    missing = F.array_compact(F.array(*[F.when(blank_to_null(F.col(f"`{r}`")).isNull(), F.lit(r))
                                        for r in required]))
    status = (F.when(empty, F.lit("empty")).when(F.size(missing) == 0, F.lit("valid"))
              .otherwise(F.lit("invalid")))
    return df.select("*", status.alias("status"),
                     F.when(~empty, F.array_join(missing, ",")).otherwise(F.lit("")).alias("missing_fields"))


def row_issue_summary(issues: DataFrame) -> DataFrame:
    """VAL3 counts: rows, empty, valid, invalid, valid % of non-empty rows (1 dp)."""
    s = F.col("status")
    nonempty = F.count_if(s != "empty")
    return issues.agg(F.count(F.lit(1)).alias("rows"), F.count_if(s == "empty").alias("empty_rows"),
                      F.count_if(s == "valid").alias("valid_rows"), F.count_if(s == "invalid").alias("invalid_rows"),
                      pct(F.count_if(s == "valid"), nonempty).alias("valid_pct"))


def type_violations(raw: Column, parsed: Column) -> Column:
    """VAL4 aggregate: non-blank cells whose parse failed (0 = the column conforms)."""
    return F.count_if(blank_to_null(raw).isNotNull() & parsed.isNull())


def dtype_class(dt: T.DataType) -> str:
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "integer"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "text"
    return dt.simpleString()


def column_profile(df: DataFrame) -> DataFrame:
    """QLT7: per column -- non-null count and %, dtype class, distinct count,
    number of text values that parse as dates, smallest text value.  All
    columns are profiled in ONE aggregation, then unpivoted to long form."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"nn{i}"), F.count_distinct(c).alias(f"nd{i}")]
        if isinstance(f.dataType, T.StringType):
            aggs += [F.count_if(dates.parse_date(c).isNotNull()).alias(f"dl{i}"), F.min(c).alias(f"mn{i}")]
        else:
            aggs += [F.lit(0).cast("long").alias(f"dl{i}"), F.lit(None).cast("string").alias(f"mn{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                             F.lit(dtype_class(f.dataType)).alias("dtype"),
                             F.col(f"nn{i}").alias("non_null"),
                             pct(F.col(f"nn{i}"), F.col("_rows")).alias("pct_non_null"),
                             F.col(f"nd{i}").alias("n_distinct"),
                             F.col(f"dl{i}").cast("long").alias("date_like"),
                             F.col(f"mn{i}").alias("min_text")))
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


DISTINCT_ERROR = 0.02     # relative standard deviation of the distinct estimate
SAMPLES = 3


def column_sketch(df: DataFrame, top: int = 5) -> DataFrame:
    """QLT7 for tables of any size, in one pass and without an expansion per column: per column the
    non-null count and %, type class, distinct estimate (relative standard deviation
    ``DISTINCT_ERROR``), text values that parse as numbers or as dates, whether the column holds
    numbers in text, shortest and longest text, ``SAMPLES`` sample values (of least hash, so
    the same in every run) and the ``top`` most frequent values (estimated).

    Every figure is a mergeable state of bounded size: tasks send one row each."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c, quoted = F.col(f"`{f.name}`"), f"`{f.name}`"
        text = c.cast("string")
        aggs += [F.count(c).alias(f"nn{i}"), F.approx_count_distinct(text, DISTINCT_ERROR).alias(f"nd{i}"),
                 F.array(*[F.min_by(text, F.when(c.isNotNull(), F.xxhash64(F.lit(k), text))) for k in range(SAMPLES)]).alias(f"sm{i}"),
                 F.expr(f"approx_top_k(cast({quoted} as string), {top})").alias(f"tk{i}")]
        if isinstance(f.dataType, T.StringType):
            shown = blank_to_null(c)
            aggs += [F.count_if(to_double(shown).isNotNull()).alias(f"nl{i}"), F.count_if(dates.parse_date(c).isNotNull()).alias(f"dl{i}"),
                     F.count(shown).alias(f"nb{i}"), F.min(F.length(c)).alias(f"lo{i}"), F.max(F.length(c)).alias(f"hi{i}")]
    one, rows = df.agg(*aggs), []
    for i, f in enumerate(fields):
        is_text = isinstance(f.dataType, T.StringType)
        n = lambda k: F.col(f"{k}{i}") if is_text else F.lit(0)  # noqa: B023, E731
        rows.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(dtype_class(f.dataType)).alias("dtype"),
            F.col(f"nn{i}").alias("non_null"), pct(F.col(f"nn{i}"), F.col("_rows")).alias("pct_non_null"),
            F.col(f"nd{i}").alias("distinct_estimate"), n("nl").cast("long").alias("numeric_like"), n("dl").cast("long").alias("date_like"),
            ((n("nb") > 0) & (n("nl") == n("nb"))).alias("numeric_text"),
            (F.col(f"lo{i}") if is_text else F.lit(None)).cast("int").alias("shortest"),
            (F.col(f"hi{i}") if is_text else F.lit(None)).cast("int").alias("longest"),
            F.array_distinct(F.array_compact(f"sm{i}")).alias("samples"),
            F.transform(F.filter(f"tk{i}", lambda t: t["item"].isNotNull()), lambda t: t["item"]).alias("top_values")))
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def frame_summary(df: DataFrame) -> DataFrame:
    """QLT8: rows, columns, all-NULL rows, duplicate rows (whole row, NULL = NULL).

    One grouping pass over whole rows; every figure is summed from the groups."""
    all_null = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in df.columns])
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_k"))
    return g.agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("long").alias("rows"),
                 F.lit(len(df.columns)).alias("columns"),
                 F.coalesce(F.sum(F.when(all_null, F.col("_k"))), F.lit(0)).cast("long").alias("all_null_rows"),
                 F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def bad_column_names(columns: Sequence[str]) -> list[str]:
    """STR15: names with forbidden characters, reserved words or over-long."""
    bad = []
    for c in columns:
        if any(ch in c for ch in FORBIDDEN_NAME_CHARS) or c.upper() in RESERVED_NAMES or len(c) > MAX_NAME_LENGTH:
            bad.append(c)
    return bad


SUPPORTED_EXPORT_TYPES = (T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.FloatType,
                          T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType,
                          T.ShortType, T.ByteType)


def export_validated(df: DataFrame, path: str) -> DataFrame:
    """QLT9 with the reference's four checks: names, types, the write to CSV and back (shape, names,
    NULL counts and content by digest, :func:`unifeed.sources.sinks.checked_write`) and the limits
    of a sheet (rows, columns, text length); score = passed checks / 4 * 100 and a label.  The
    table is written to ``path`` when this is called."""
    from ..sources.sinks import checked_write
    trip = checked_write(df, path, "csv")
    size_ok = (F.col("over_limit_cells") == 0) & (F.col("rows") <= MAX_ROWS) & F.lit(len(df.columns) <= MAX_COLUMNS)
    passed = ((F.col("bad_column_names") == 0).cast("int") + (F.col("type_score") >= 95).cast("int")
              + F.lit(int(trip["ok"])) + size_ok.cast("int"))
    score = passed * 25.0
    return export_check(df).select("rows", "columns", "bad_column_names", "type_score", F.lit(trip["ok"]).alias("round_trip"),
                                   size_ok.alias("fits_a_sheet"), score.alias("score"), _export_label(score).alias("label"))


def _export_label(score: Column) -> Column:
    return (F.when(score >= 95, F.lit("compatible")).when(score >= 85, F.lit("mostly compatible"))
            .when(score >= 70, F.lit("needs work")).otherwise(F.lit("incompatible")))


def export_check(df: DataFrame) -> DataFrame:
    """QLT9: export compatibility in one pass -- column-name rules (STR15), share of columns
    of a supported type without over-long text (32,767 characters), over-long cells, row and
    column limits; score = passed checks / 4 * 100 and a label.  The write-and-read-back
    test is a job of its own (:func:`unifeed.sources.sinks.roundtrip_check`)."""
    names_bad = bad_column_names(df.columns)
    fields = df.schema.fields
    supported = sum(isinstance(f.dataType, SUPPORTED_EXPORT_TYPES) for f in fields)
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    longest = [F.coalesce(F.max(F.length(F.col(f"`{t}`"))), F.lit(0)) for t in texts]
    max_len = F.greatest(*longest) if len(texts) > 1 else (longest[0] if texts else F.lit(0))
    over = reduce(lambda a, b: a + b, [F.count_if(F.length(F.col(f"`{t}`")) > MAX_TEXT_LENGTH) for t in texts], F.lit(0))
    long_columns = reduce(lambda a, b: a + b, [(x > MAX_TEXT_LENGTH).cast("int") for x in longest], F.lit(0))
    a = df.agg(F.count(F.lit(1)).alias("rows"), max_len.alias("max_text_length"), over.cast("long").alias("over_limit_cells"),
               (F.lit(100.0) * (F.lit(supported) - long_columns) / max(len(fields), 1)).alias("type_score"))
    text_ok = F.col("over_limit_cells") == 0
    size_ok = (F.col("rows") <= MAX_ROWS) & F.lit(len(df.columns) <= MAX_COLUMNS)
    passed = (F.lit(int(not names_bad)) + (F.col("type_score") >= 95).cast("int") + text_ok.cast("int") + size_ok.cast("int"))
    score = passed * 25.0
    label = _export_label(score)
    return a.select("rows", F.lit(len(df.columns)).alias("columns"), "max_text_length", "over_limit_cells",
                    F.lit(len(names_bad)).alias("bad_column_names"), "type_score", score.alias("score"), label.alias("label"))


def event_header_columns(columns: Sequence[str], keywords: Sequence[str] = EVENT_HEADER_KEYWORDS) -> list[str]:
    """STR16: headers containing any event keyword (case-insensitive) -- schema
    metadata only, no data is read."""
    return [c for c in columns if any(k in str(c).lower() for k in keywords)]


def quality_gate(scores: DataFrame, score_col: str = "overall", min_score: float = MIN_QUALITY_SCORE,
                 strict: bool = False) -> DataFrame:
    """QLT10: flag a run whose score is below ``min_score``; ``strict`` fails the
    job with ``raise_error`` instead (evaluated on the executors)."""
    ok = F.col(score_col) >= F.lit(min_score)
    out = scores.withColumn("passed", ok)
    if strict:
        out = out.withColumn("passed", F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.format_string("quality score %s below %s", F.col(score_col).cast("string"),
                                          F.lit(str(min_score))))))
    return out
