"""The production run (§3.1) as one lazy DataFrame plan.

sources -> per-source recipes -> union -> contamination filter -> gap-fill
anti-join -> feed.  Nothing is collected; summaries read the same plan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import route_table
from ..operators import standardize
from ..operators.combine import contamination_flag, gap_fill, remove_contamination
from ..operators.schema import CANONICAL_COLUMNS, union_sources
from ..session import scratch_table
from . import driver_tables as dt

GAP_SOURCE = "cad_ce"


@dataclass
class FeedRun:
    """Result tables of one run (all lazy)."""
    feed: DataFrame
    sources: dict[str, DataFrame]
    removed: DataFrame
    gap_dropped: DataFrame
    routed: DataFrame
    extras: dict = field(default_factory=dict)


def _as_of() -> _dt.date:
    return _dt.date.fromisoformat(dt.PROCESSED_DATE)


def driver_sources(spark: SparkSession, sf_dir: str, routed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Canonical frames of the four derived sources (dispatch rows routed, CSB excluded)."""
    pd_ = _as_of()
    routed = routed if routed is not None else dispatch_routed(spark, sf_dir)
    return {
        "outreach_log": standardize.community_log(dt.community_raw(spark, sf_dir),
                                                          processed_date=pd_),
        "stacp": standardize.stacp_log(dt.stacp_raw(spark, sf_dir), processed_date=pd_,
                                       aliases=dt.DEMO_ALIASES),
        "patrol": standardize.patrol_log(dt.patrol_raw(spark, sf_dir), processed_date=pd_),
        GAP_SOURCE: routed.where(F.col("include")).select(*CANONICAL_COLUMNS),
    }


def dispatch_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.dispatch_export(dt.cad_raw(spark, sf_dir), route_table(spark),
                                       data_source=GAP_SOURCE, processed_date=_as_of(),
                                       keep=("event_id",))


def build_feed(spark: SparkSession, sf_dir: str, gap_fill_enabled: bool = True,
               blank_matches: bool = True) -> FeedRun:
    """§3.1: union -> FLT1 -> JOI1 (order matters: filter before gap-fill)."""
    routed = dispatch_routed(spark, sf_dir)
    sources = driver_sources(spark, sf_dir, routed)
    combined = union_sources(sources.values())
    kept, removed = remove_contamination(combined)
    src = F.col("data_source")
    record = kept.where(src != GAP_SOURCE)
    gap = kept.where(src == GAP_SOURCE)
    if gap_fill_enabled:
        gap_kept, gap_dropped = gap_fill(record, gap, blank_matches=blank_matches)
    else:
        gap_kept, gap_dropped = gap, gap.where(F.lit(False))
    feed = record.unionByName(gap_kept)
    return FeedRun(feed=feed, sources=sources, removed=removed, gap_dropped=gap_dropped,
                   routed=routed)


def run_production(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """§3.1 as a job: build the feed, write it (SNK1, month-partitioned parquet),
    then compute every report from the *written* table -- the write cuts the
    lineage, so a lost executor during reporting re-reads the table instead of
    recomputing four sources -- and write the result tables (SNK2-SNK5)."""
    import datetime as _dt2

    from ..operators import quality, report
    from ..sources import sinks

    started = _dt2.datetime.now(_dt2.timezone.utc).replace(tzinfo=None)
    sources = driver_sources(spark, sf_dir)
    # every source is parsed once; feed, removed and dropped rows are told apart in what was written
    tagged = scratch_table(union_sources(sources.values()).withColumn("_removed", contamination_flag()))
    kept, removed = tagged.where(~F.col("_removed")).drop("_removed"), tagged.where("_removed").drop("_removed")
    record, gap = kept.where(F.col("data_source") != GAP_SOURCE), kept.where(F.col("data_source") == GAP_SOURCE)
    gap_kept, gap_dropped = gap_fill(record, gap)
    feed_path = sinks.write_feed(record.unionByName(gap_kept), f"{out_dir.rstrip('/')}/combined")
    feed = spark.read.parquet(feed_path).drop("year_month")
    tables = {
        "office_summary": report.office_summary(feed),
        "bureau_rollup": report.bureau_rollup(feed),
        "presentation": report.presentation(feed).orderBy("Date"),
        "removed_rows": removed,
        "gap_dropped": gap_dropped,
        "run_summary": sinks.run_summary(spark, feed, list(sources), [], started),
        "quality": quality.combined_score(feed),
    }
    paths = sinks.write_tables(tables, out_dir)
    paths["combined"] = feed_path
    return paths
