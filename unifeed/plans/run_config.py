"""Config-driven production run (SRC9, SRC10, SNK4; §3.1).

A run configuration lists sources; each names a reader, its path(s) or
sheets, an optional ``disabled`` flag and the recipe that maps it to the
canonical feed.  Building a source is lazy; a source that fails (missing
file, missing required columns, bad config) is recorded in the status table
and skipped -- it never stops the run.  Only the small status list lives on
the driver.
"""

from __future__ import annotations

import datetime as _dt
from typing import Any, Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import route_table
from ..operators import contract as C
from ..operators import report, standardize
from ..operators.combine import contamination_flag, gap_fill, remove_contamination
from ..operators.schema import CANONICAL_COLUMNS, require_columns, union_sources
from ..sources import sinks
from ..sources.files import read_delimited, read_parquet
from ..sources.workbook import by_header, read_workbooks, rows_to_frame
from .release import GateFailed, Release

RECIPES: dict[str, Callable[..., DataFrame]] = {
    "community": standardize.community_log,
    "stacp": standardize.stacp_log,
    "patrol": standardize.patrol_log,
}


def _read(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    kind = spec.get("format", "parquet")
    path = spec["path"]
    if kind in ("csv", "tsv"):
        return read_delimited(spark, path, sep="\t" if kind == "tsv" else spec.get("sep", ","))
    if kind == "xlsx":
        rows = read_workbooks(spark, path, spec.get("sheets"))
        broken = rows.where(F.col("error").isNotNull()).select("file", "error").orderBy("file")
        first = broken.first()
        if first is not None:       # name the first file; all of them are in ``rows``
            raise ValueError(f"unreadable workbook {first['file']}: {first['error']}")
        if spec.get("by_position"):
            return rows_to_frame(rows, spec["columns"])
        return by_header(rows, spec["columns"], spec.get("header_row"))
    return read_parquet(spark, path)


def build_source(spark: SparkSession, name: str, spec: Mapping[str, Any],
                 processed_date: _dt.date) -> DataFrame:
    raw = _read(spark, spec)
    if spec.get("required"):
        require_columns(raw, spec["required"])
    recipe = spec.get("recipe", "community")
    if recipe == "dispatch":
        routed = standardize.dispatch_export(raw, route_table(spark), data_source=name,
                                             processed_date=processed_date)
        return routed.where(F.col("include")).select(*CANONICAL_COLUMNS)
    kwargs = dict(spec.get("options", {}))
    return RECIPES[recipe](raw, data_source=name, processed_date=processed_date, **kwargs)


def run(spark: SparkSession, config: Mapping[str, Any], processed_date: _dt.date,
        gap_source: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Build every enabled source, isolate failures, union, filter, gap-fill.

    Returns ``(feed or None, status)`` where ``status`` has one row per
    configured source: ``(source, status, error)``."""
    frames: dict[str, DataFrame] = {}
    status = []
    for name, spec in config.get("sources", {}).items():
        if spec.get("disabled"):
            status.append((name, "disabled", None))
            continue
        try:
            df = build_source(spark, name, spec, processed_date)
            df.schema  # analysis errors surface here, per source  # noqa: B018
            frames[name] = df
            status.append((name, "ok", None))
        except Exception as e:  # one failing source must not stop the run
            status.append((name, "failed", f"{type(e).__name__}: {e}"))
    status_df = spark.createDataFrame(status, "source string, status string, error string")
    if not frames:
        return None, status_df
    kept, _removed = remove_contamination(union_sources(frames.values()))
    if gap_source and gap_source in frames:
        src = F.col("data_source")
        record, gap = kept.where(src != gap_source), kept.where(src == gap_source)
        gap_kept, _ = gap_fill(record, gap)
        kept = record.unionByName(gap_kept)
    return kept, status_df


def _measures():
    """What is counted while a source is written: rows, rejects, NULLs by canonical column."""
    n = lambda cond: F.count_if(cond)
    kept = F.size(C.REASONS) == 0
    return [F.count(F.lit(1)).alias("rows_read"), n(~kept).alias("rows_rejected"),
            *[n(kept & F.col(c).isNull()).alias(f"null_{c}") for c in CANONICAL_COLUMNS]]


def _tagged_source(spark: SparkSession, name: str, spec: Mapping[str, Any], processed_date: _dt.date) -> DataFrame:
    """Every row of a source in canonical form with ``reject_reasons`` and, where rejected, the raw
    record.  Dispatch rows that routing excludes are rejected with the reason ``route``."""
    raw = C.read_delimited_rescued(spark, spec["path"], "\t" if spec["format"] == "tsv" else spec.get("sep", ",")) \
        if spec.get("format") in ("csv", "tsv") else _read(spark, spec)
    rules = spec.get("contract") or C.Contract()
    rules = C.Contract((*spec.get("required", ()), *rules.required), rules.not_blank, rules.kinds)
    cells = [F.col(f"`{c}`") for c in raw.columns if c != C.CORRUPT]
    whole = F.to_json(F.struct(*cells))
    record = F.coalesce(F.col(C.CORRUPT), whole) if C.CORRUPT in raw.columns else whole
    marked = C.with_reasons(raw, rules, name).withColumn("record", F.when(F.size(C.REASONS) > 0, record))
    keep = (C.REASONS, "record")
    recipe = spec.get("recipe", "community")
    if recipe == "dispatch":
        routed = standardize.dispatch_export(marked, route_table(spark), data_source=name, processed_date=processed_date, keep=keep)
        out = F.when(F.col("include"), F.col(C.REASONS)).otherwise(F.array_append(C.REASONS, F.lit("route")))
        return routed.withColumn(C.REASONS, out).select(*CANONICAL_COLUMNS, *keep)
    return RECIPES[recipe](marked, data_source=name, processed_date=processed_date, keep=keep, **dict(spec.get("options", {})))


def run_job(spark: SparkSession, config: Mapping[str, Any], base: str, processed_date: _dt.date,
            gap_source: str | None = None, run_id: str | None = None, feed_path: str | None = None) -> Release:
    """The configured run as a job with a manifest (SRC9, SNK1-SNK4).

    Each source is scanned once: it is written in canonical form, and its rows, rejects and NULL
    counts are observed while it is written.  A source that fails, while it is planned or
    while it is read, is recorded with its error and the run goes on.  The feed (filter, then
    gap-fill), rejects, presentation and ``run_summary`` (one row per configured source, whatever
    became of it) are computed from the written tables and published together; the run fails, and
    nothing is published, if no source could be read or rows went missing.  ``feed_path``: a
    feed by month in which the months of this run are replaced once it is published."""
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run_, frames, status = Release(spark, base, run_id), {}, []
    for name, spec in config.get("sources", {}).items():
        if spec.get("disabled"):
            status.append((name, "disabled", None, {}))
            continue
        try:
            seen = Observation()
            first, *rest = _measures()
            tagged = _tagged_source(spark, name, spec, processed_date).observe(seen, first, *rest)
            frames[name] = run_.stage(f"source_{name}", tagged)
            status.append((name, "ok", None, dict(seen.get)))
        except Exception as e:  # one failing source must not stop the run
            status.append((name, "failed", f"{type(e).__name__}: {e}".splitlines()[0][:2000], {}))
    rows = [(run_.run_id, started, n, s, err, m.get("rows_read"), m.get("rows_rejected"),
             m["rows_read"] - m["rows_rejected"] if m else None,
             {k[5:]: v for k, v in m.items() if k.startswith("null_")} if m else None) for n, s, err, m in status]
    summary = spark.createDataFrame(rows, "run_id string, started timestamp, source string, status string, error string, "
                                    "rows_read long, rows_rejected long, rows_kept long, nulls map<string,long>")
    if not frames:
        raise GateFailed(f"run {run_.run_id} not published: no source could be read: "
                         + "; ".join(f"{n}: {e}" for n, _, e, _ in status))
    run_.stage("run_summary", summary)
    rejects = [df.where(F.size(C.REASONS) > 0).select(F.lit(n).alias("source"), F.col(C.REASONS).alias("reasons"), "record")
               for n, df in frames.items()]
    whole = rejects[0]
    for r in rejects[1:]:
        whole = whole.unionByName(r)
    run_.stage("rejects", whole)
    combined = union_sources([df.where(F.size(C.REASONS) == 0).drop(C.REASONS, "record") for df in frames.values()])
    flagged = run_.stage("combined", combined.withColumn("_removed", contamination_flag()))
    kept, removed = flagged.where(~F.col("_removed")).drop("_removed"), flagged.where("_removed").drop("_removed")
    run_.stage("removed_rows", removed)
    n_dropped = 0
    if gap_source and gap_source in frames:
        record, gap = kept.where(F.col("data_source") != gap_source), kept.where(F.col("data_source") == gap_source)
        gap_kept, gap_dropped = gap_fill(record, gap)
        run_.stage("gap_dropped", gap_dropped)
        n_dropped, kept = run_.rows["gap_dropped"], record.unionByName(gap_kept)
    feed = run_.stage("feed", kept, sort=["date", "office", "event_name"])
    run_.stage("presentation", report.presentation(feed), sort=["Date", "Office", "Event Name"])
    n = run_.rows
    run_.gate_equal("rows read are kept or rejected", sum(m.get("rows_read", 0) for *_, m in status), n["combined"] + n["rejects"])
    run_.gate_equal("rows kept are in the feed, removed or already recorded", n["combined"],
                    n["feed"] + n["removed_rows"] + n_dropped)
    run_.publish()
    if feed_path:
        sinks.update_months(feed.where(F.col("date").isNotNull()), feed_path)
    return run_
