"""People-list scalars: splitting, rank stripping, rosters, officer forms
(STR8-STR14, NUM2, NUM3).

Arrays are built and filtered with higher-order functions; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blank_to_null, col_, ws_trim

# Rank words stripped from the front of a name (one, optional
# dot, then whitespace; case-insensitive) -- STR10.
RANK_WORDS = ("PO", "Sgt", "Lt", "Det", "Cpl", "Ofc", "Officer", "Sergeant",
              "Lieutenant", "Detective", "Corporal")
RANK_PREFIX = r"(?i)^(" + "|".join(RANK_WORDS) + r")\.?\s+"
# Entries of a people field that are not person names -- STR12.
NON_NAME_ENTRIES = ("squad formation", "n/a", "none", "tbd", "unknown")
# Delimiters between people -- STR11 (patrol form) and STR13 (simple form).
PEOPLE_SPLIT = r"(?i)\s*[,/&;]\s*|\s+and\s+"
SIMPLE_SPLIT = r"[,/&]"
FREE_TEXT_SPLIT = r"\s*/\s*|\s*,\s*"


def normalize_name(c) -> Column:
    """STR10: trim, strip one leading rank, put a space after a leading initial."""
    t = ws_trim(col_(c))
    t = ws_trim(F.regexp_replace(t, RANK_PREFIX, ""))
    return F.regexp_replace(t, r"^([A-Za-z])\.(\S)", "$1. $2")


def split_people(c) -> Column:
    """STR11: split a people field on ``, / & ;`` or the word ``and``; normalise; drop empties."""
    t = ws_trim(col_(c))
    parts = F.split(t, PEOPLE_SPLIT)
    return F.filter(F.transform(parts, normalize_name), lambda x: x != F.lit(""))


def patrol_field(c) -> Column:
    """STR12: ``struct(names ARRAY<STRING>, n BIGINT)`` for a patrol people cell.

    blank -> ([], 0); all digits -> ([], n); non-name entry -> ([text], 0);
    otherwise the STR11 split and its size.
    """
    t = blank_to_null(c)
    empty = F.array().cast(T.ArrayType(T.StringType()))
    names = split_people(t)
    return (F.when(t.isNull(), F.struct(empty.alias("names"), F.lit(0).cast("long").alias("n")))
            .when(t.rlike(r"^\d+$"),
                  F.struct(empty.alias("names"), t.try_cast(T.LongType()).alias("n")))
            .when(F.lower(t).isin(*NON_NAME_ENTRIES),
                  F.struct(F.array(t).alias("names"), F.lit(0).cast("long").alias("n")))
            .otherwise(F.struct(names.alias("names"), F.size(names).cast("long").alias("n"))))


def fallback_one(count, *required) -> Column:
    """NUM3: a zero count becomes 1 when every required field is present."""
    present = None
    for r in required:
        p = blank_to_null(r).isNotNull()
        present = p if present is None else present & p
    cnt = col_(count)
    return F.when((cnt == 0) & present, F.lit(1).cast("long")).otherwise(cnt)


def simple_count(*cols) -> Column:
    """STR13: sum over columns of the non-blank parts of a ``[,/&]`` split."""
    total = None
    for c in cols:
        parts = F.split(F.coalesce(col_(c).cast("string"), F.lit("")), SIMPLE_SPLIT)
        n = F.size(F.filter(parts, lambda x: ws_trim(x) != F.lit(""))).cast("long")
        total = n if total is None else total + n
    return total


def nonblank_count(*cols) -> Column:
    """NUM2: number of non-blank cells among ``cols``."""
    total = None
    for c in cols:
        n = F.when(blank_to_null(c).isNotNull(), 1).otherwise(0)
        total = n if total is None else total + n
    return total.cast("long")


def roster_names(primary, extras, free_text) -> Column:
    """STR14: primary + extra dropdowns (one person each, never split) + free text
    split on ``/`` or ``,``.  Blanks are dropped; duplicates are kept.

    The split pattern swallows the whitespace around each separator and the
    text is trimmed first, so the parts need no per-element trim; NULLs become
    blanks and blanks are removed with ``array_remove`` (no lambdas)."""
    singles = [F.coalesce(ws_trim(col_(c).cast("string")), F.lit("")) for c in (primary, *extras)]
    free = ws_trim(F.coalesce(col_(free_text).cast("string"), F.lit("")))
    arr = F.concat(F.array(*singles), F.split(free, FREE_TEXT_SPLIT))
    return F.array_remove(arr, "")


def alias_map_lookup(name, mapping: dict[str, str]) -> Column:
    """JOI3 for a small constant alias table: exact match on ``lower(trim)``."""
    if not mapping:
        return col_(name)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = F.lower(ws_trim(col_(name)))
    return F.coalesce(F.try_element_at(m, key), col_(name))


def officer_key(c) -> Column:
    """STR8: last usable token, lower-cased; badge numbers and ``X.`` ranks dropped."""
    toks = F.filter(F.split(ws_trim(F.coalesce(col_(c), F.lit(""))), r"\s+"),
                    lambda t: (t != F.lit("")) & ~F.regexp_replace(t, r"\.+$", "").rlike(r"^\d+$")
                    & ~t.endswith("."))
    return F.coalesce(F.lower(F.try_element_at(toks, F.lit(-1))), F.lit(""))


def officer_initial_form(c) -> Column:
    """STR9: ``Rank First Last 123`` -> ``F. Last``; a single token stays as is."""
    toks = F.filter(F.split(ws_trim(F.coalesce(col_(c), F.lit(""))), r"\s+"),
                    lambda t: (t != F.lit("")) & ~F.regexp_replace(t, r"\.+$", "").rlike(r"^\d+$")
                    & ~t.endswith("."))
    n = F.size(toks)
    rest = F.array_join(F.slice(toks, 2, F.greatest(n - 1, F.lit(1))), " ")
    return (F.when(n >= 2, F.concat(F.substring(F.element_at(toks, 1), 1, 1), F.lit(". "), rest))
            .otherwise(F.array_join(toks, " ")))

