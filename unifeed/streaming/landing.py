"""Incremental pick-up of newly landed exports (optional extension X1).

The reference re-runs a batch job when a new monthly export lands.  Here a
Structured Streaming query watches the landing directory; each micro-batch
(``trigger(availableNow=True)`` processes everything new, then stops) runs the
same batch operators through ``foreachBatch`` and appends to the feed table.
Progress lives in a checkpoint under the cluster's shared
``spark.checkpoint.dir``, so a restarted job never reprocesses or skips a file.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def start_landing_job(spark: SparkSession, landing_dir: str, schema: T.StructType,
                      transform: Callable[[DataFrame], DataFrame], output_dir: str,
                      name: str = "landing", fmt: str = "parquet",
                      checkpoint: str | None = None, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (call ``awaitTermination``).

    ``transform`` is any batch operator chain (canonical recipe, contamination
    filter, ...); each micro-batch result is appended to ``output_dir``.
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        stream = reader.option("header", True).csv(landing_dir)
    else:
        stream = reader.format(fmt).load(landing_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        # idempotent per batch id: a retried batch overwrites its own folder
        out.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
