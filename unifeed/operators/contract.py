"""What a source must look like, checked before and while it is read (SRC5, VAL1).

A missing required column fails the source by name before any row is read.  Malformed
*records* never fail it: each row carries the reasons it is rejected for, so that the rows
in are the rows kept plus the rows rejected, and the rejects are a table of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, durations
from ..functions.text import missing_to_null, to_double
from .schema import MissingColumnsError, header_lookup, missing_columns

CORRUPT = "_corrupt_record"
REASONS = "reject_reasons"


@dataclass(frozen=True)
class Contract:
    """``required`` columns must exist; cells of ``not_blank`` must hold something; a cell that
    holds something must parse as its kind (``date``, ``clock`` or ``number``)."""
    required: Sequence[str] = ()
    not_blank: Sequence[str] = ()
    kinds: Mapping[str, str] = field(default_factory=dict)


_PARSED = {"date": lambda c: dates.parse_date(c, normalized=True),
           "clock": lambda c: durations.clock_seconds(c, normalized=True),
           "number": to_double}


def check_columns(df: DataFrame, contract: Contract, source: str) -> DataFrame:
    """VAL1: raise, naming the source and every column it lacks; else ``df`` unchanged."""
    needed = dict.fromkeys([*contract.required, *contract.not_blank, *contract.kinds])
    missing = missing_columns(df, needed)
    if missing:
        raise MissingColumnsError(f"{source}: missing required columns: {missing}")
    return df


def _failed(df: DataFrame, name: str, kind: str) -> Column:
    """A cell that holds something its kind cannot read (typed cells are read already)."""
    actual = header_lookup(df)[name.rstrip()]
    c = F.col(f"`{actual}`")
    if not isinstance(df.schema[actual].dataType, T.StringType):
        return F.lit(False)
    text = missing_to_null(c)
    return text.isNotNull() & _PARSED[kind](text).isNull()


def with_reasons(df: DataFrame, contract: Contract, source: str = "source") -> DataFrame:
    """``df`` and ``reject_reasons`` (empty for rows to keep): ``blank:<column>``,
    ``<kind>:<column>`` and ``record`` for a line whose cells do not fit the header."""
    check_columns(df, contract, source)
    look = header_lookup(df)
    marks = [F.when(missing_to_null(F.col(f"`{look[c.rstrip()]}`").cast("string")).isNull(), F.lit(f"blank:{c}"))
             for c in contract.not_blank]
    marks += [F.when(_failed(df, c, kind), F.lit(f"{kind}:{c}")) for c, kind in contract.kinds.items()]
    if CORRUPT in df.columns:
        marks.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("record")))
    reasons = F.array_compact(F.array(*marks)) if marks else F.array()
    return df.withColumn(REASONS, reasons.cast("array<string>"))


def accepted(df: DataFrame) -> DataFrame:
    """The rows to keep, without the contract's columns."""
    return df.where(F.size(REASONS) == 0).drop(REASONS, CORRUPT)


def rejects(df: DataFrame, source: str) -> DataFrame:
    """(source, reasons, record): the rejected rows; ``record`` is the line as it stood if its cells
    do not fit, else the row as JSON."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (REASONS, CORRUPT)]
    whole = F.to_json(F.struct(*cols))
    record = F.coalesce(F.col(CORRUPT), whole) if CORRUPT in df.columns else whole
    return df.where(F.size(REASONS) > 0).select(F.lit(source).alias("source"), F.col(REASONS).alias("reasons"),
                                                record.alias("record"))


def reason_counts(df: DataFrame) -> DataFrame:
    """(reason, rows): how many rows each reason rejects."""
    return df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def read_delimited_rescued(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """SRC2 / SRC3 with nothing lost: text cells by the file's own header, and the whole line in
    ``_corrupt_record`` where its cells are more or fewer than the header's.  A file whose header
    differs from the first one's fails the scan (cells would be taken by position)."""
    paths = [path] if isinstance(path, str) else list(path)
    options = {"header": True, "sep": sep, "escape": '"', "encoding": "UTF-8"}
    names = [c.lstrip("﻿") for c in spark.read.options(**options, inferSchema=False).csv(paths).columns]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField(CORRUPT, T.StringType())])
    # every column is parsed whatever is asked for later: a pruned parse does not see extra cells
    return (spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False,
                               enforceSchema=False).schema(schema).csv(paths))
