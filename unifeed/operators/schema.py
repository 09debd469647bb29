"""Canonical event schema, column mapping, union and column checks
(PRJ1, PRJ2, PRJ5, PRJ6, REL1, REL2, VAL1, FLT8)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null

# The canonical event feed, core columns in export order.
CANONICAL_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("duration_hours", T.DoubleType()),
    T.StructField("attendee_count", T.LongType()),
    T.StructField("office", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("attendee_names", T.StringType()),
    T.StructField("data_source", T.StringType()),
    T.StructField("processed_date", T.DateType()),
])
CANONICAL_COLUMNS = [f.name for f in CANONICAL_SCHEMA.fields]
# Standard columns added as NULL when a mapping leaves them out (PRJ1).
STANDARD_FILL = ("start_time", "end_time", "duration_hours", "attendee_count",
                 "office", "division")


class MissingColumnsError(ValueError):
    """VAL1: a required column is absent."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """VAL1: raise listing every missing required column; returns ``df`` unchanged."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """REL2: required names absent from ``df`` (headers compared after right-trim)."""
    have = {c.rstrip() for c in df.columns}
    return [c for c in required if c.rstrip() not in have]


def header_lookup(df: DataFrame) -> dict[str, str]:
    """Right-trimmed header -> actual header (one sheet header ends in a space)."""
    return {c.rstrip(): c for c in df.columns}


def apply_mapping(df: DataFrame, mapping: Mapping[str, str], keep_extras: bool = False) -> DataFrame:
    """PRJ1: rename ``source header -> canonical`` for present headers; absent
    mapped headers are reported by :func:`missing_columns`, never fatal.

    Extras (unmapped raw columns) survive only with ``keep_extras``.
    """
    look = header_lookup(df)
    cols: list[Column] = []
    used = set()
    for src, dst in mapping.items():
        actual = look.get(src.rstrip())
        if actual is not None:
            cols.append(F.col(f"`{actual}`").alias(dst))
            used.add(actual)
    if keep_extras:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*cols)


def fill_standard(df: DataFrame, names: Iterable[str] = STANDARD_FILL) -> DataFrame:
    """PRJ1: add missing standard columns as typed NULLs."""
    types = {f.name: f.dataType for f in CANONICAL_SCHEMA.fields}
    add = {n: F.lit(None).cast(types[n]) for n in names if n not in df.columns}
    return df.withColumns(add) if add else df


def tag(df: DataFrame, **literals) -> DataFrame:
    """PRJ2: literal columns (office, division, data_source, processed_date...)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in literals.items()})


def to_canonical(df: DataFrame, keep_extras: bool = False) -> DataFrame:
    """Cast/complete to the canonical schema; core columns first, extras after (PRJ5)."""
    cols = []
    for f in CANONICAL_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extras:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in CANONICAL_COLUMNS]
    return df.select(*cols)


def order_columns(df: DataFrame) -> DataFrame:
    """PRJ5: canonical core columns first, every other column after in input order."""
    core = [c for c in CANONICAL_COLUMNS if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in core + [c for c in df.columns if c not in core]])


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """REL1: union-all by name, NULL-filling columns a source lacks;
    ``attendee_names`` NULL -> ``""``."""
    frames = list(frames)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if "attendee_names" in out.columns:
        out = out.withColumn("attendee_names", F.coalesce(F.col("attendee_names"), F.lit("")))
    return out


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """PRJ6: headers starting with ``prefix`` (e.g. ``Participating Member``)."""
    return [c for c in df.columns if c.startswith(prefix)]


def all_blank(*cols) -> Column:
    """FLT8: every listed cell is NULL or whitespace."""
    return reduce(lambda a, b: a & b, [blank_to_null(c).isNull() for c in cols])
