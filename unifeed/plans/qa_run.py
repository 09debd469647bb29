"""The QA run as one job (SNK5, SRC5, VAL1): dispatch export against the hand-kept log.

One table is written from the export, every row of it tagged (contract reasons, route); all
reports are computed from that table and appear together or not at all (:mod:`.release`):
reconciliation, conflict candidates, proposals, imputed, unrouted, duplicates, rejects and
the checks themselves.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import durations
from ..functions.numbers import route_table
from ..operators import contract as C
from ..operators import reconcile as R
from ..operators import standardize
from ..operators.combine import route_split
from ..operators.schema import CANONICAL_COLUMNS
from .release import Release

DISPATCH_CONTRACT = C.Contract(required=standardize.DISPATCH_COLUMNS, not_blank=("Time of Call",),
                               kinds={"Time of Call": "date"})
_CLOCK_OF_CALL = r"(\d{1,2}:\d{2}(:\d{2})?)"


def tagged_dispatch(spark: SparkSession, raw: DataFrame, row_id: str, contract: C.Contract = DISPATCH_CONTRACT,
                    data_source: str = "cad_ce", processed_date: _dt.date | None = None) -> DataFrame:
    """Every row of the export once: routed and repaired, with ``cad_id``, the second of the call,
    ``reject_reasons`` and (for rejected rows) the raw record.  A missing column raises by name."""
    marked = C.with_reasons(raw, contract, data_source)
    call = F.regexp_extract(F.col("`Time of Call`").cast("string"), _CLOCK_OF_CALL, 1)
    raw_cols = [F.col(f"`{c}`") for c in raw.columns if c != C.CORRUPT]
    whole = F.to_json(F.struct(*raw_cols))
    record = F.coalesce(F.col(C.CORRUPT), whole) if C.CORRUPT in raw.columns else whole
    marked = marked.withColumns({
        "cad_id": F.col(f"`{row_id}`"), "call_s": durations.clock_seconds(call),
        "record": F.when(F.size(C.REASONS) > 0, record)})
    return standardize.dispatch_export(marked, route_table(spark), data_source=data_source, processed_date=processed_date,
                                       keep=("cad_id", "call_s", "record", C.REASONS))


def qa_run(spark: SparkSession, raw: DataFrame, log: DataFrame, base: str, row_id: str, month: _dt.date,
           taken_ids: DataFrame | None = None, contract: C.Contract = DISPATCH_CONTRACT,
           processed_date: _dt.date | None = None, run_id: str | None = None) -> Release:
    """Run the QA reports of ``month`` (its first day) and publish them under ``base``.

    ``raw``: the dispatch export with a unique ``row_id``; ``log``: (row_idx, date, location) of the
    hand-kept log; ``taken_ids``: its ids (event_id), which proposals do not reuse.  Raises
    ``MissingColumnsError`` before anything is written, or ``GateFailed`` with nothing published, if
    rows are lost between export and tables, a row to publish has no office or lies outside
    the month, or the reconciliation does not have one row per verified call."""
    C.check_columns(raw, contract, "cad_ce")
    run, seen = Release(spark, base, run_id), Observation()
    counted = raw.observe(seen, F.count(F.lit(1)).alias("rows"))     # rows in, counted by the same scan
    whole = run.stage("dispatch", tagged_dispatch(spark, counted, row_id, contract, processed_date=processed_date))
    rows_in = int(seen.get["rows"])

    good = whole.where(F.size(C.REASONS) == 0)
    run.stage("rejects", whole.where(F.size(C.REASONS) > 0).select(
        "data_source", "cad_id", F.col(C.REASONS).alias("reasons"), "record"))
    parts = route_split(good.drop(C.REASONS, "record"))
    preview = run.stage("preview", parts["csv"].select("cad_id", "case_no", *CANONICAL_COLUMNS))
    verified = run.stage("verified_calls", parts["sta"].drop("dest"))
    result = run.stage("reconciliation", R.reconcile(verified, log))
    run.stage("conflict_candidates", R.conflict_candidates(result, log))
    run.stage("proposals", R.proposals(result, taken=taken_ids), sort=["date", "event_id"])
    run.stage("imputed", good.where("imputed").select("cad_id", "date", "attendee_names", "location", "duration_hours"))
    unrouted = run.stage("unrouted", parts["unrouted"].select(
        "cad_id", "case_no", "date", "event_name", "attendee_names", "squad", "reason"))
    same = ["case_no", "date", "start_time", "event_name", "location"]
    run.stage("duplicates", good.groupBy(*same).agg(F.count(F.lit(1)).alias("rows"), F.min("cad_id").alias("first_id"))
              .where("rows > 1"))
    run.stage("class_counts", R.class_counts(result))

    n = run.rows
    run.gate_equal("all rows of the export are in the run", rows_in, n["dispatch"])
    run.gate_equal("rows are published, verified, unrouted or rejected", n["dispatch"],
                   n["preview"] + n["verified_calls"] + n["unrouted"] + n["rejects"])
    run.gate_equal("one reconciliation row per verified call", n["reconciliation"], n["verified_calls"])
    bad = lambda df, cond: df.agg(F.count_if(cond).alias("k")).select(
        (F.col("k") == 0).alias("ok"), F.concat(F.col("k").cast("string"), F.lit(" rows")).alias("detail"))
    run.gate("no blank office", bad(preview, F.coalesce(F.trim("office"), F.lit("")) == ""))
    run.gate("dates in the month", bad(preview, F.coalesce(F.trunc("date", "month") != F.lit(month), F.lit(True))))
    run.gate("unrouted rows have a reason", bad(unrouted, F.col("reason").isNull()))
    run.publish()
    return run
