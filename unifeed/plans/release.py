"""Results that appear together or not at all (SNK2-SNK5).

A run writes its tables into a folder of its own, where no reader looks, and re-reads them:
every later table and every check is computed from what was written, so a lost executor
re-reads files instead of recomputing sources.  Checks run on the written tables.  Only if
all hold is one small manifest written that names the run's tables; readers follow the newest
manifest.  A run whose check fails, or that dies, leaves the published state as it was.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import run_stamp

_MANIFEST = "run_id string, table string, path string, rows long, published timestamp"


class GateFailed(RuntimeError):
    """Checks of a run that do not hold; nothing was published."""


class Release:
    """One run under ``base``: :meth:`stage` tables, add :meth:`gate` checks, then :meth:`publish`."""

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.run_id = run_id or f"{run_stamp()}_{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, DataFrame] = {}
        self.rows: dict[str, int] = {}
        self._gates: list[DataFrame] = []

    def path(self, name: str) -> str:
        return f"{self.base}/runs/{self.run_id}/{name}"

    def stage(self, name: str, df: DataFrame, sort: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table of the run and return it as written.  ``sort`` orders the whole table (by
        ranges, so files in name order are in row order); rows are counted while they are written."""
        seen = Observation()
        out = df.orderBy(*sort) if sort else df
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))      # above the sort, whose sampling reads its input too
        writer = out.write.mode("error")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))
        self.rows[name] = int(seen.get["rows"])
        # partition columns come last when read back
        order = [c for c in df.columns if c not in partition_by] + list(partition_by)
        self.tables[name] = self.spark.read.schema(df.select(*[F.col(f"`{c}`") for c in order]).schema).parquet(self.path(name))
        return self.tables[name]

    def gate(self, name: str, ok: DataFrame) -> None:
        """A check: a one-row frame (ok boolean, detail string) over staged tables; NULL fails."""
        self._gates.append(ok.select(F.lit(name).alias("check"), F.coalesce(F.col("ok"), F.lit(False)).alias("ok"),
                                     F.col("detail").cast("string").alias("detail")))

    def gate_equal(self, name: str, left: int, right: int) -> None:
        """A check on two numbers of rows counted while tables were written."""
        self.gate(name, self.spark.range(1).select(F.lit(left == right).alias("ok"), F.lit(f"{left} and {right}").alias("detail")))

    def publish(self) -> DataFrame:
        """Evaluate the checks, stage them as ``checks``, then write the manifest; return the checks."""
        checks = self._gates[0]
        for g in self._gates[1:]:
            checks = checks.unionByName(g)
        checks = self.stage("checks", checks)
        failed = [f"{r['check']} ({r['detail']})" for r in checks.where(~F.col("ok")).orderBy("check").collect()]  # one row a check
        if failed:
            raise GateFailed(f"run {self.run_id} not published: " + "; ".join(failed))
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = [(self.run_id, n, f"runs/{self.run_id}/{n}", self.rows[n], now) for n in self.tables]
        # one file, renamed into place as a whole: the moment the run is published
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.base}/manifest/{self.run_id}")
        return checks


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """All published tables of all runs."""
    return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(f"{base.rstrip('/')}/manifest")


def published(spark: SparkSession, base: str, table: str, run_id: str | None = None) -> DataFrame:
    """A published table of the newest run (or of ``run_id``)."""
    rows = manifest(spark, base).where(F.col("table") == table)
    if run_id:
        rows = rows.where(F.col("run_id") == run_id)
    found = rows.agg(F.max_by("path", F.struct("published", "run_id")).alias("path")).first()
    if found.path is None:
        raise LookupError(f"no published table {table!r}" + (f" in run {run_id}" if run_id else ""))
    return spark.read.parquet(f"{base.rstrip('/')}/{found.path}")
