"""Location and case-number scalars (STR1-STR7, REL3).

The same keys are used by the gap-fill anti-join (JOI1) and the
reconciliation match (JOI2), so they are defined once here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blank_to_null, col_, to_double, ws_trim

# Tokens ignored when comparing locations (STR3).
LOCATION_STOPWORDS = ("the", "and", "of", "at", "a", "an")
# Separators that mark one cell naming two or more places (STR5/STR6).
COMBINED_PATTERN = r"\band\b|[/&,]|\+"
JACCARD_MIN = 0.5


def case_number(c) -> Column:
    """STR1: trim, drop CR/LF, drop one trailing ``.0``; blank -> ``""``."""
    t = F.coalesce(blank_to_null(c), F.lit(""))
    t = F.regexp_replace(t, r"[\r\n]", "")
    return F.regexp_replace(t, r"\.0$", "")


def location_key(c) -> Column:
    """STR2: lower-case and delete everything but ``[a-z0-9]``; blank -> ``""``."""
    return F.regexp_replace(F.lower(F.coalesce(col_(c).cast("string"), F.lit(""))), "[^a-z0-9]", "")


def location_tokens(c) -> Column:
    """STR3: distinct alphanumeric tokens minus stopwords (sorted, so sets compare by value)."""
    t = F.regexp_replace(F.lower(F.coalesce(col_(c).cast("string"), F.lit(""))), "[^a-z0-9 ]", " ")
    toks = F.filter(F.split(t, " "), lambda x: (x != F.lit("")))
    stop = F.array(*[F.lit(w) for w in LOCATION_STOPWORDS])
    return F.array_sort(F.array_except(toks, stop))


def location_match(a_key, a_tok, b_key, b_tok) -> Column:
    """STR4 on precomputed keys/tokens: non-empty keys and (equal, either contains
    the other, or token Jaccard >= 0.5)."""
    ak, bk, at, bt = col_(a_key), col_(b_key), col_(a_tok), col_(b_tok)
    inter = F.size(F.array_intersect(at, bt))
    union = F.size(F.array_union(at, bt))
    jacc = (F.size(at) > 0) & (F.size(bt) > 0) & (inter / union >= JACCARD_MIN)
    return ((ak != "") & (bk != "")
            & ((ak == bk) | F.contains(ak, bk) | F.contains(bk, ak) | jacc))


def is_combined(c) -> Column:
    """STR5: the cell names two or more places (``and``, ``/``, ``&``, ``,``, ``+``)."""
    t = blank_to_null(c)
    return F.coalesce(F.lower(t).rlike(COMBINED_PATTERN), F.lit(False))


def location_parts(c) -> Column:
    """STR6 components: the lower-cased cell split on the combined-place separators."""
    return F.split(F.lower(F.coalesce(col_(c).cast("string"), F.lit(""))), COMBINED_PATTERN)


def compose_location(business, st_number, street) -> Column:
    """STR7: business name, else ``int(number) street`` (``251.0`` -> ``251``)."""
    num = blank_to_null(st_number)
    as_int = to_double(num).try_cast(T.LongType()).cast("string")
    num_txt = F.coalesce(as_int, num, F.lit(""))
    st = F.coalesce(blank_to_null(street), F.lit(""))
    addr = ws_trim(F.concat_ws(" ", num_txt, st))
    return F.coalesce(blank_to_null(business), addr)
