"""Prefix sums and ranks over a whole table without a task that sees all rows.

Rows carry a part (the task that wrote them) and a place within it.  Only the
totals of the parts are summed up, in two levels, so the largest window holds
``FAN`` parts or one row per ``FAN`` parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.sources.workdir import fresh_folder

FAN = 4096
# Totals of so many parts, 16 bytes each, are small enough to tell every task.
TOLD_PARTS = 1 << 20
# monotonically_increasing_id keeps the part above these bits and the place below.
_PLACE_BITS = 33


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder, read back: lineage ends here."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def portions(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``size`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = sizes.to_numpy(zero_copy_only=False).astype("int64").cumsum()
        at = 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + size
            stop = max(at + 1, int(ends.searchsorted(limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def totals_before(parts: DataFrame, size: str) -> DataFrame:
    """(part, before): the sum of ``size`` over all smaller parts; one row per part."""
    blocked = parts.select("part", size, F.floor(F.col("part") / FAN).alias("block"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("block").agg(F.sum(size).alias("whole")).select(
        "block", F.coalesce(F.sum("whole").over(across), F.lit(0)).alias("base"))
    return blocked.join(blocks, "block").select(
        "part", (F.col("base") + F.coalesce(F.sum(size).over(inside), F.lit(0))).alias("before"))


def with_totals(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with ``before`` of their part.

    The totals have two numbers per part.  They are counted, and told to every
    task while they are at most ``TOLD_PARTS``; beyond that both sides are
    shuffled by part.
    """
    kept = written(totals, "totals")
    few = kept.count() <= TOLD_PARTS
    return rows.join(F.broadcast(kept) if few else kept, "part")


def ranked(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``rows`` with their number from 1 in the given order over the whole table.

    Range partitions are numbered in order; each row's number is the count of
    rows in lower partitions plus its place in its own.
    """
    placed = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", _PLACE_BITS)
    parts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (
        with_totals(placed.withColumn("part", part), totals_before(parts, "n"))
        .select(*rows.columns, (F.col("before") + inside + 1).alias(rank))
    )
