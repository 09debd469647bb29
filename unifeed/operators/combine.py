"""Combining sources: contamination filter, gap-fill anti-join, routing splits,
alias lookup (FLT1, FLT2, JOI1, JOI3, NUM5, OUT2, OUT4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, places
from ..functions.text import ws_trim

# Contamination rules (FLT1).  Office names compared after
# trim + lower-case; event-name patterns matched case-insensitively on the
# untrimmed name.
CONTAMINATION_OFFICES = ("crime suppression bureau", "csb")
CONTAMINATION_EVENT_PATTERNS = (
    r"\(Monthly Total\)",
    r"^Arrests$",
    r"^Motor Vehicle Stops$",
    r"^Motor Vehicle Theft$",
    r"^BWC Review",
    r"^Warrant Arrests$",
    r"^Subpoenas Generated$",
    r"^Surveillance Reports$",
    r"^Generated Complaints$",
    r"^Drug-Related Arrests$",
    r"^City Ordinance Citation$",
    r"^Assist Outside Agency$",
    r"^High Valued Item Seized$",
)
CONTAMINATION_REGEX = "(?i)" + "|".join(CONTAMINATION_EVENT_PATTERNS)
# The same rule in two parts: patterns tried at the start of a name only, and those anywhere in it.
_AT_START = "(?i)^(?:" + "|".join(p[1:] for p in CONTAMINATION_EVENT_PATTERNS if p.startswith("^")) + ")"
_ANYWHERE = "(?i)" + "|".join(p for p in CONTAMINATION_EVENT_PATTERNS if not p.startswith("^"))


def contamination_flag(office: str = "office", event_name: str = "event_name") -> Column:
    """FLT1 predicate; NULLs never match."""
    off = F.lower(ws_trim(F.col(office))).isin(*CONTAMINATION_OFFICES)
    name = F.col(event_name)
    # what is looked for anywhere begins with a bracket: test the cheap character first
    ev = name.rlike(_AT_START) | ((F.instr(name, "(") > 0) & name.rlike(_ANYWHERE))
    return F.coalesce(off, F.lit(False)) | F.coalesce(ev, F.lit(False))


def remove_contamination(df: DataFrame, office: str = "office",
                         event_name: str = "event_name") -> tuple[DataFrame, DataFrame]:
    """FLT1: ``(kept, removed)``; ``removed`` is the audit listing."""
    flag = contamination_flag(office, event_name)
    return df.where(~flag), df.where(flag)


def gap_fill_keys(df: DataFrame, date_col: str = "date", loc_col: str = "location") -> list[Column]:
    """JOI1 key: canonical date text + collapsed location; blanks as ``""``."""
    return [dates.date_key_of(df, date_col).alias("_k_date"),
            places.location_key(F.col(loc_col)).alias("_k_loc")]


def gap_fill(record: DataFrame, gap: DataFrame, blank_matches: bool = True,
             date_col: str = "date", loc_col: str = "location") -> tuple[DataFrame, DataFrame]:
    """JOI1: drop a gap-source row when any record row has the same
    ``(date, location)`` key; return ``(kept_gap_rows, dropped_gap_rows)``.

    The record side is reduced to its distinct keys before the join, so the
    build side grows with distinct events, not rows, and partial aggregation
    collapses hot keys map-side.  ``blank_matches=True`` follows the reference
    (blank = blank matches); ``False`` never drops on a blank key part.
    """
    rk = record.select(*gap_fill_keys(record, date_col, loc_col)).distinct()
    gk = gap.select("*", *gap_fill_keys(gap, date_col, loc_col))
    if not blank_matches:
        rk = rk.where((F.col("_k_date") != "") & (F.col("_k_loc") != ""))
    on = ["_k_date", "_k_loc"]
    kept = gk.join(rk, on, "left_anti").drop(*on)
    dropped = gk.join(rk, on, "left_semi").drop(*on)
    return kept, dropped


def combine_with_gap_fill(frames: dict[str, DataFrame], gap_source: str,
                          blank_matches: bool = True) -> tuple[DataFrame, dict[str, DataFrame]]:
    """§3.1 step 4: union, contamination filter, then gap-fill (in that order,
    so a removed workbook row cannot suppress a gap-source row).

    Returns the combined feed and the audit frames ``removed`` / ``gap_dropped``.
    """
    from .schema import union_sources
    combined = union_sources(frames.values())
    kept, removed = remove_contamination(combined)
    src = F.col("data_source")
    record = kept.where(src != gap_source)
    gap = kept.where(src == gap_source)
    gap_kept, gap_dropped = gap_fill(record, gap, blank_matches)
    return record.unionByName(gap_kept), {"removed": removed, "gap_dropped": gap_dropped}


def route_split(routed: DataFrame) -> dict[str, DataFrame]:
    """OUT2/OUT4: destination views over one routed frame (``include`` from NUM5)."""
    dest = (F.when(~F.col("include"), F.lit("csb"))
            .when(F.col("squad") == "STA", F.lit("sta"))
            .otherwise(F.lit("csv")))
    d = routed.withColumn("dest", dest)
    return {"csv": d.where(F.col("dest") == "csv"), "sta": d.where(F.col("dest") == "sta"),
            "csb": d.where(F.col("dest") == "csb"),
            "unrouted": d.where(~F.col("include")).withColumn(
                "reason", F.concat(F.lit("squad "), F.coalesce(F.col("squad"), F.lit("<blank>")),
                                   F.lit(" excluded from the feed")))}


def apply_alias_table(names: DataFrame, alias: DataFrame, id_col: str, names_col: str,
                      alias_key: str = "alias_key", canonical: str = "canonical") -> DataFrame:
    """JOI3 with an alias *table*: every name in ``names_col`` (ARRAY<STRING>) is
    replaced by its canonical form when ``lower(trim(name))`` equals an alias key.

    Each *distinct list* of names is resolved once (exploded with positions, joined to the
    de-duplicated alias table, put together in order) and joined back to the rows by the list, so
    rows are never told apart by an id: repeated ids and repeated rows stay as they are, with all
    their columns.  A NULL list becomes an empty one.  ``id_col`` names a column to keep first."""
    a = alias.select(F.lower(ws_trim(F.col(alias_key))).alias("_ak"),
                     F.col(canonical).alias("_canon")) \
        .groupBy("_ak").agg(F.min("_canon").alias("_canon"))
    lists = names.select(F.col(names_col).alias("_list")).where(F.size("_list") > 0).distinct()
    ex = lists.select("_list", F.posexplode("_list").alias("_pos", "_name"))
    j = ex.join(a, F.lower(ws_trim(F.col("_name"))) == F.col("_ak"), "left")
    item = F.struct(F.col("_pos"), F.coalesce(F.col("_canon"), F.col("_name")).alias("n"))
    resolved = j.groupBy("_list").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["n"]).alias("_new"))
    out = names.join(resolved, F.col(names_col) == F.col("_list"), "left")
    rest = [F.col(f"`{c}`") for c in names.columns if c not in (id_col, names_col)]
    empty = F.array().cast("array<string>")
    return out.select(id_col, F.coalesce("_new", names_col, empty).alias(names_col), *rest)
