"""Date scalars: canonical date parsing, period extraction (DAT1, DAT3, DAT4, SRC7, SRC8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_, digits_to, missing_to_null

# Accepted date layouts as (shape, ISO rewrite).  Shapes are
# anchored so a bare clock such as "0900" never parses; two-digit years are 20yy.
DATE_LAYOUTS = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})([ T].*)?$", "$1-$2-$3"),   # ISO date / date-time
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})( .*)?$", "$3-$1-$2"),      # M/d/yyyy, also with a time
    (r"^(\d{1,2})/(\d{1,2})/(\d{2})( .*)?$", "20$3-$1-$2"),    # M/d/yy, also with a time
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})( .*)?$", "$1-$2-$3"),      # yyyy/M/d
)
# Month names as written in "Oct 1, 2025" and "October 1 2025".
NAMED_DATE = r"^([A-Za-z]{3})[a-z]{0,6}\.? (\d{1,2}),? (\d{4})( .*)?$"
MONTH_LETTERS = "janfebmaraprmayjunjulaugsepoctnovdec"
ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"

# Month abbreviations for sheet names like "25_Jan" (SRC8).
MONTH_ABBR = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN",
              "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def date_iso(c, normalized: bool = False) -> Column:
    """DAT1 stage 1: rewrite any accepted layout to ``yyyy-M-d`` (other text unchanged)."""
    t = col_(c) if normalized else missing_to_null(col_(c).cast(T.StringType()))
    (iso_p, iso_r), (us4_p, us4_r), (us2_p, us2_r), (ymd_p, ymd_r) = DATE_LAYOUTS
    at = F.instr(F.lit(MONTH_LETTERS), F.lower(F.regexp_extract(t, NAMED_DATE, 1)))
    named = F.when(at % 3 == 1, F.concat_ws("-", F.regexp_extract(t, NAMED_DATE, 3), ((at + 2) / 3).cast("int").cast("string"),
                                            F.regexp_extract(t, NAMED_DATE, 2))).otherwise(t)
    # slash layouts, month names and dash layouts are disjoint: test the cheap character first
    # likewise the slash layouts: by the place of the first slash, then by the length of the year
    year = F.substring_index(F.substring_index(t, " ", 1), "/", -1)
    return (F.when(F.instr(t, "/") == 5, F.regexp_replace(t, ymd_p, ymd_r))
            .when((F.instr(t, "/") > 0) & (F.length(year) == 2), F.regexp_replace(t, us2_p, us2_r))
            .when(F.instr(t, "/") > 0, F.regexp_replace(t, us4_p, us4_r))
            .when(F.substring(t, 1, 1).between("A", "z") & t.rlike(NAMED_DATE), named)
            .otherwise(F.regexp_replace(t, iso_p, iso_r)))


def date_from_iso(iso) -> Column:
    """DAT1 stage 2: cast only the exact ``yyyy-M-d`` shape; impossible days -> NULL."""
    iso = col_(iso)
    return F.when(iso.rlike(ISO_DAY), iso.try_cast(T.DateType()))


def parse_date(c, normalized: bool = False) -> Column:
    """DAT1: text in any accepted layout -> DATE; NULL when blank or unparseable.

    Each layout is rewritten to ``yyyy-M-d`` by one regex replace; only that
    exact shape is cast, so impossible days (``02/30/2026``) are NULL and
    nothing else is guessed.  ``normalized=True``: input is trimmed text.
    Staged callers project :func:`date_iso` and decode with :func:`date_from_iso`.
    """
    return date_from_iso(date_iso(c, normalized))


def date_key(c) -> Column:
    """DAT1 key form: ``YYYY-MM-DD`` for parseable dates, raw trimmed text else, ``""`` blank."""
    d = parse_date(c)
    raw = missing_to_null(col_(c).cast(T.StringType()))
    return F.coalesce(F.date_format(d, "yyyy-MM-dd"), raw, F.lit(""))


def date_of(df, name: str) -> Column:
    """The calendar date of column ``name`` of ``df``: typed dates pass through,
    timestamps are truncated, text goes through :func:`parse_date`."""
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return c.cast(T.DateType())
    return parse_date(c)


def date_key_of(df, name: str) -> Column:
    """DAT1 key form of ``df[name]`` without re-parsing typed dates."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(date_of(df, name).cast(T.StringType()), F.lit(""))
    return date_key(F.col(f"`{name}`"))


def month_start(year, month) -> Column:
    return F.make_date(col_(year), col_(month), F.lit(1))


def period_from_file_name(name) -> Column:
    """SRC7: ``2026_05_CE...`` -> 2026-05-01; NULL when the name has no period."""
    n = col_(name)
    pat = r"^(\d{4})_(\d{2})_"
    y = digits_to(F.regexp_extract(n, pat, 1))
    m = digits_to(F.regexp_extract(n, pat, 2))
    return F.when(n.rlike(pat) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def period_from_sheet_name(name) -> Column:
    """SRC8: ``26_01`` / ``x_24_11`` -> 20yy-mm-01; ``25_Jan`` -> 2025-01-01; else NULL.

    Month abbreviations are matched case-insensitively (the reference maps
    only some title-case forms and falls back to January).
    """
    n = col_(name)
    num = r"(\d{2})_(\d{2})$"
    ny = digits_to(F.regexp_extract(n, num, 1))
    nm = digits_to(F.regexp_extract(n, num, 2))
    word = r"^(\d{2})_([A-Za-z]{3})"
    wy = digits_to(F.regexp_extract(n, word, 1))
    ab = F.upper(F.regexp_extract(n, word, 2))
    wm = F.array_position(F.array(*[F.lit(a) for a in MONTH_ABBR]), ab).cast("int")
    return (F.when(n.rlike(num) & nm.between(1, 12), F.make_date(ny + 2000, nm, F.lit(1)))
            .when(n.rlike(word) & (wm > 0), F.make_date(wy + 2000, wm, F.lit(1))))


def in_period(date_col, first_day) -> Column:
    """FLT3: sargable month filter ``first <= d < first + 1 month``."""
    d, f = col_(date_col), col_(first_day)
    return (d >= f) & (d < F.add_months(f, 1))


def rolling_months(date_col, as_of, months: int = 13) -> Column:
    """FLT4: the last ``months`` calendar months including the month of ``as_of``."""
    d = col_(date_col)
    start = F.add_months(F.trunc(col_(as_of), "MM"), -(months - 1))
    end = F.add_months(F.trunc(col_(as_of), "MM"), 1)
    return (d >= start) & (d < end)
