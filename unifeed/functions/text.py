"""Blank handling, trimming and numeric-text gates (FLT9, §2.16 traps).

All functions map ``Column -> Column`` and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numeric text accepted by the engine (stricter than Python
# ``float``: no ``1_000``, ``inf``, ``nan``; stricter than Spark casts: no ``2d``).
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INT_PATTERN = r"^\d+$"
# Leading/trailing whitespace, the analogue of Python ``str.strip`` (the
# characters of the regex class ``\s``: space, tab, LF, CR, FF, VT).
EDGE_WS = r"^\s+|\s+$"
WS_CHARS = " \t\n\r\f\u000b"
# Text values that mean "missing" in spreadsheet exports.
MISSING_WORDS = ("nan", "none", "nat", "null")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_trim(c) -> Column:
    """Strip whitespace at both ends (plain ``trim`` strips spaces only); a
    character-set trim, no regex."""
    return F.trim(col_(c), F.lit(WS_CHARS))


def blank_to_null(c) -> Column:
    """Trimmed text, NULL when the cell is NULL or only whitespace (FLT9)."""
    t = ws_trim(col_(c).cast(T.StringType()))
    return F.when(t != F.lit(""), t)


def is_blank(c) -> Column:
    return blank_to_null(c).isNull()


def missing_to_null(c) -> Column:
    """Like :func:`blank_to_null` but also maps ``nan``/``none``/``nat``/``null``."""
    t = ws_trim(col_(c).cast(T.StringType()))
    # NULL, blank or missing: no branch, so NULL; one test of the trimmed text
    return F.when(~F.lower(t).isin("", *MISSING_WORDS), t)


def to_double(c) -> Column:
    """Gated numeric parse: NULL unless the trimmed text is a plain decimal."""
    t = ws_trim(col_(c).cast(T.StringType()))
    # the gate guarantees a parseable decimal, so a plain cast never fails
    return F.when(t.rlike(NUMBER_PATTERN), t.cast(T.DoubleType()))


def digits_to(c, dtype: str = "int") -> Column:
    """Cast text known to be digits-or-empty (a regex group) without the slow
    failing-cast path: empty -> NULL, anything else cast directly."""
    x = col_(c)
    return F.when(F.length(x) > 0, x.cast(dtype))


def to_long_floor(c) -> Column:
    """``int(float(x))``: parse a decimal and truncate toward zero; NULL if not numeric."""
    return to_double(c).try_cast(T.LongType())


def coalesce_blank(c, default: str = "") -> Column:
    """Blank/NULL text as ``default`` (the reference compares blanks as ``""``)."""
    return F.coalesce(blank_to_null(c), F.lit(default))
