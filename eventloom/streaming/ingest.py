"""Incremental loads with Structured Streaming.

The checkpoint remembers which files have been read, so each run loads only
new ones.  A failed batch leaves the checkpoint where it was and is repeated
under the same load id.  Writers must move finished files into the source
folder: a file is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventloom.plans.pipeline import Warehouse, load_lines
from eventloom.sources.raw_logs import read_raw_stream
from eventloom.sources.tables import line_blocks


def _load_id(batch: DataFrame, batch_id: int) -> str:
    """Stable over retries of a batch, distinct over checkpoints."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"stream-{query}-{batch_id}"


def start_ingest(spark: SparkSession, source: str, warehouse: Warehouse, checkpoint: str,
                 glob: str | None = None, max_files: int | None = None,
                 every: str | None = None, loaded: list[int] | None = None) -> StreamingQuery:
    """Start loading new files; once through what is there, or ``every`` interval.

    The numbers of finished batches are added to ``loaded``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        load_lines(batch, warehouse, _load_id(batch, batch_id))
        if loaded is not None:
            loaded.append(batch_id)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        read_raw_stream(spark, source, glob, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest_stream(spark: SparkSession, source: str, warehouse: Warehouse, checkpoint: str,
                  glob: str | None = None, max_files: int | None = None) -> int:
    """Load all new files, wait for the end, and return the batches run."""
    loaded: list[int] = []
    # A stream takes its scans' block size from the session that it was started in.
    with line_blocks(spark):
        query = start_ingest(spark, source, warehouse, checkpoint, glob, max_files, loaded=loaded)
        query.awaitTermination()
    return len(set(loaded))
