"""Duration, clock and time-of-day scalars (DUR1-DUR5, TIM1, TIM2, DAT2).

Clock values are carried as seconds-of-day integers; ``HH:MM`` text is only
produced at the edge (TIM1).  Everything is a native column expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import round_half_even
from .text import NUMBER_PATTERN, col_, missing_to_null

# Fixed values used by the reference rules.
DEFAULT_HOURS = 0.5          # duration when nothing usable is given (DUR3)
MEMORIAL_MAX_HOURS = 2 / 60  # spans below two minutes are imputed (DUR4)
IMPUTED_HOURS = 0.5          # imputed span, also the proposal span (DUR4, OUT1)
CLAMP_MAX_HOURS = 24.0       # presentation clamp upper bound (DUR5)
CLAMP_FALLBACK_HOURS = 8.0   # value used above the clamp (DUR5)

# "0 days 01:15:00", "1 day 2:00"
_DAYS = r"^(\d+)\s*days?\s+(\d+):(\d{1,2})(:(\d{1,2}))?$"
# "1:30", "1:30:36"
_HMS = r"^(\d+):(\d{1,2})(:(\d{1,2}))?$"
# "5 Hrs. 00 Mins", "1 Hour", "2 hrs", "1 hr 30 min"
_WORDS = r"^(\d+(\.\d+)?)\s*(h|hr|hrs|hour|hours)\.?(\s*(\d+)\s*(m|min|mins|minute|minutes)\.?)?$"
# clock text: "10:00", "9:30", "0900", "17:45:10"
CLOCK_PATTERN = r"^(\d{1,2}):?(\d{2})(:(\d{2}))?$"


def _grp(t: Column, pattern: str, i: int) -> Column:
    # groups hold digits (or a decimal) or nothing, which counts as 0; one extraction a group
    return F.concat(F.lit("0"), F.regexp_extract(t, pattern, i)).cast("double")


def duration_hours(c, normalized: bool = False, positive_only: bool = True) -> Column:
    """DUR1: duration text -> positive hours, else NULL.

    Accepts plain numbers, ``H:MM[:SS]``, ``N days HH:MM[:SS]`` (days are
    counted, unlike the reference) and ``N Hrs. M Mins`` / ``N Hour`` forms.
    Zero, negative, blank, ``nan``/``none``/``nat`` and anything else -> NULL;
    callers pick the default with ``coalesce``.  With ``normalized=True`` the
    input is already lower-cased, trimmed text (see :func:`duration_text`).
    """
    t = col_(c) if normalized else duration_text(c)
    # each layout's regex runs only when a character it requires is present
    # (``day``, ``:``, ``h``) -- implied by the patterns, so results are unchanged
    has_day, has_colon, has_h = F.instr(t, "day") > 0, F.instr(t, ":") > 0, F.instr(t, "h") > 0
    hours = (
        F.when(t.rlike(NUMBER_PATTERN), t.cast(T.DoubleType()))
        .when(has_day & t.rlike(_DAYS),
              _grp(t, _DAYS, 1) * 24.0 + _grp(t, _DAYS, 2)
              + _grp(t, _DAYS, 3) / 60.0 + _grp(t, _DAYS, 5) / 3600.0)
        .when(has_colon & t.rlike(_HMS),
              _grp(t, _HMS, 1) + _grp(t, _HMS, 2) / 60.0 + _grp(t, _HMS, 4) / 3600.0)
        .when(has_h & t.rlike(_WORDS), _grp(t, _WORDS, 1) + _grp(t, _WORDS, 5) / 60.0)
    )
    return F.when(hours > 0, hours) if positive_only else hours


def duration_text(c) -> Column:
    """Normalised duration text: trimmed, lower-cased, blank/``nan`` -> NULL."""
    return F.lower(missing_to_null(col_(c).cast(T.StringType())))


# The same shape with the ranges encoded (hour 0-23, minute/second 0-59).
CLOCK_STRICT = r"^([01]?\d|2[0-3]):?([0-5]\d)(:([0-5]\d))?$"


CLOCK_DATE = r"^\d{4}-\d{1,2}-\d{1,2}[ T]"
CLOCK_AMPM = r"^((?:0?[1-9]|1[0-2]):[0-5]\d)(:[0-5]\d)? ?([AP])\.?M\.?$"
DAY_FRACTION = r"^0?\.\d+$"


def clock_digits(c, normalized: bool = False) -> Column:
    """DAT2 stage 1: the digits of a valid clock text (``930``, ``0930``,
    ``93015``, ``174510``), NULL when the text is not a valid clock.  A date before the
    clock is dropped (``1899-12-30 10:00:00``), ``2:05 PM`` counts from noon and a fraction of
    a day below one (``0.4167``, a spreadsheet time) is rounded to the second."""
    t = col_(c) if normalized else missing_to_null(col_(c).cast(T.StringType()))
    # few uses of ``t``: optimizer rules copy this expression into filters
    after = F.when(F.instr(t, "-") > 0, F.regexp_replace(t, CLOCK_DATE, "")).otherwise(t)
    half = F.regexp_replace(F.upper(t), CLOCK_AMPM, "$1$2 $3M")
    # only text of the right shape is parsed or cast (failures are slow); sessions are in UTC
    noon = F.date_format(F.try_to_timestamp(half, F.lit("h:mm[:ss] a")), "HHmmss")
    part = F.date_format(F.timestamp_seconds(F.round(t.cast("double") * 86400)), "HHmmss")
    return (F.when(after.rlike(CLOCK_STRICT), F.translate(after, ":", ""))
            .when(t.rlike("(?i)" + CLOCK_AMPM), noon)
            .when(t.rlike(DAY_FRACTION), part))


def clock_from_digits(d) -> Column:
    """DAT2 stage 2: digits -> seconds of day.  3-4 digits are ``[H]HMM``, 5-6
    digits ``[H]HMMSS`` -- unambiguous because minutes and seconds always
    have two digits."""
    d = col_(d)
    v = d.cast("int")
    hi = F.floor(v / 100).cast("int")
    return F.when(F.length(d) <= 4, hi * 3600 + (v % 100) * 60) \
        .otherwise(F.floor(v / 10000).cast("int") * 3600 + (hi % 100) * 60 + v % 100)


def clock_seconds(c, normalized: bool = False) -> Column:
    """DAT2: clock text (``10:00``, ``9:30``, ``0900``, ``17:45:10``, ``2:05 PM``) -> seconds of day.

    Out-of-range parts (hour > 23, minute/second > 59) give NULL.  Staged
    callers should project :func:`clock_digits` first and decode it with
    :func:`clock_from_digits` in the next projection.
    """
    return clock_from_digits(clock_digits(c, normalized))


def timestamp_seconds(c) -> Column:
    """Seconds since midnight of a timestamp column."""
    ts = col_(c)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def elapsed_hours(start_s, end_s, wrap_midnight: bool = True) -> Column:
    """DUR2: hours from start to end seconds-of-day; optionally wrap past midnight."""
    d = col_(end_s) - col_(start_s)
    if wrap_midnight:
        d = F.when(d < 0, d + 86400).otherwise(d)
    return d / 3600.0


def pick_duration(given, elapsed, default: float | None = DEFAULT_HOURS,
                  scale: int = 2) -> Column:
    """DUR3: given (>0) -> elapsed (>0) -> default, banker's rounding."""
    e = col_(elapsed)
    parts = [col_(given), F.when(e > 0, e)]
    if default is not None:
        parts.append(F.lit(float(default)))
    return round_half_even(F.coalesce(*parts), scale)


def _two_digits(x: Column) -> Column:
    """``%02d`` for a non-negative integer without ``java.util.Formatter``."""
    t = x.cast("string")
    return F.when(x < 10, F.concat(F.lit("0"), t)).otherwise(t)


def hhmm(seconds) -> Column:
    """TIM1: seconds -> ``HH:MM`` (minutes floored; hours may exceed 23)."""
    s = col_(seconds)
    h = F.floor(s / 3600)
    m = F.floor((s % 3600) / 60)
    return F.when(s.isNotNull(), F.concat(_two_digits(h), F.lit(":"), _two_digits(m)))


def add_minutes_of_day(seconds, minutes: int = 30) -> Column:
    """TIM2: shift a clock by ``minutes`` modulo 24 h."""
    return F.pmod(col_(seconds) + minutes * 60, F.lit(86400))


def memorial_guard(out_s, in_s, on_inversion: str = "impute"):
    """DUR4: returns ``(duration_hours, imputed, end_seconds)`` columns.

    The span ``round(in - out, 4)`` in hours below two minutes (including any
    negative span -- no midnight wrap, as in production) is replaced by the
    imputed half hour and the end clock moves to start + 30 min.  A missing
    side yields NULL duration and no imputation.  ``on_inversion="reject"`` leaves spans
    that end before they start without a duration instead.
    """
    if on_inversion not in ("impute", "reject"):
        raise ValueError(f"on_inversion: {on_inversion!r}")
    o, i = col_(out_s), col_(in_s)
    span = round_half_even((i - o) / 3600.0, 4)
    both = o.isNotNull() & i.isNotNull()
    rejected = (both & (i < o)) if on_inversion == "reject" else F.lit(False)
    imputed = both & (span < F.lit(MEMORIAL_MAX_HOURS)) & ~rejected
    dur = F.when(imputed, F.lit(IMPUTED_HOURS)).when(both & ~rejected, span)
    end = F.when(imputed, add_minutes_of_day(o, int(IMPUTED_HOURS * 60))).otherwise(i)
    return dur, imputed, end


def clamp_presentation_hours(c) -> Column:
    """DUR5: NULL/<=0 -> 0.5; >24 -> 8.0; else round half-even to 2 places."""
    x = col_(c)
    return (F.when(x.isNull() | (x <= 0), F.lit(DEFAULT_HOURS))
            .when(x > CLAMP_MAX_HOURS, F.lit(CLAMP_FALLBACK_HOURS))
            .otherwise(round_half_even(x, 2)))
