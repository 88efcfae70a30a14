"""What became of every stage of every load.

Entries are appended, one small file each, to a folder per load, so a load reads
only its own.  Results are done, started and failed, with the error's text.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schema import JOURNAL_SCHEMA

_ENTRY = ("stage", "result", "detail")
_MOST_DETAIL = 2000


@dataclass(frozen=True)
class Journal:
    """The journal below one folder."""

    spark: SparkSession
    path: str

    def entries(self, load_id: str | None = None) -> DataFrame:
        """All entries, or those of one load; none while nothing is recorded."""
        folder = self.path if load_id is None else f"{self.path}/load_id={load_id}"
        try:
            return self.spark.read.schema(JOURNAL_SCHEMA).option("basePath", self.path).json(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], JOURNAL_SCHEMA)

    def has(self, load_id: str, stage: str) -> bool:
        """Whether a stage of the load was ever started."""
        return not self.entries(load_id).filter(F.col("stage") == stage).isEmpty()

    def record(self, load_id: str, *results: tuple[str, str, str | None]) -> None:
        """Append (stage, result, detail) entries in one file."""
        entries = F.array(*[
            F.struct(*[F.lit(value).cast("string").alias(name) for name, value in zip(_ENTRY, result)])
            for result in results])
        rows = self.spark.range(0, 1, 1, 1).select(F.inline(entries))
        rows.withColumn("recorded_at", F.current_timestamp()).write.mode("append").json(
            f"{self.path}/load_id={load_id}")

    @contextmanager
    def watching(self, load_id: str, stage: str) -> Iterator[None]:
        """Record a failure of the stage and let it through."""
        try:
            yield
        except Exception as error:
            self.record(load_id, (stage, "failed", str(error)[:_MOST_DETAIL]))
            raise

    def latest(self) -> DataFrame:
        """(load_id, stage, result, detail, recorded_at): the last entry of each stage."""
        entry = F.struct("recorded_at", "result", "detail")
        return self.entries().groupBy("load_id", "stage").agg(F.max(entry).alias("e")).select(
            "load_id", "stage", "e.result", "e.detail", "e.recorded_at")
