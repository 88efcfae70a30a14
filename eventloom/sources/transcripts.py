"""Transcript files: their last lines, without reading a file as one row.

Files are scanned as lines in blocks that Spark deals out to tasks, so a file of
any size is read by many of them.  Only lines near the end of a file go on; of
those each task keeps the last few per file before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.schema import TRANSCRIPT_TAIL_LINES
from eventloom.sources.raw_logs import list_files
from eventloom.sources.workdir import fresh_folder

# The first look covers the blocks that reach into the last so many bytes.
TAIL_BYTES = 1 << 20
_WIDEN = 16


def tail_lines(spark: SparkSession, path: str, lines: int, tail_bytes: int,
               above: int = -1, glob: str | None = None) -> DataFrame:
    """(path, n, tail): the last ``lines`` lines found near the end of each file.

    Looks at the blocks that overlap the last ``tail_bytes`` of files larger
    than ``above`` bytes; smaller files are not opened.  A line belongs to the
    block it starts in, so blocks by their start and lines by their place in
    the scan are the order of the file.  ``n`` counts the lines kept.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = {name: F.col(f"_metadata.{name}") for name in ("file_size", "file_block_start", "file_block_length")}
    near = (meta["file_size"] > above) & (
        meta["file_block_start"] + meta["file_block_length"] > meta["file_size"] - tail_bytes)
    near_end = reader.load(path).filter(near)
    placed = near_end.select(
        F.col("_metadata.file_path").alias("path"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("place"), "value")
    newest = Window.partitionBy("path").orderBy(F.desc("block"), F.desc("place"))
    last = placed.withColumn("back", F.row_number().over(newest)).filter(F.col("back") <= lines)
    line = F.struct((-F.col("back")).alias("pos"), "value")
    return last.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(line))["value"].alias("tail"))


def read_transcripts(spark: SparkSession, path: str, lines: int = TRANSCRIPT_TAIL_LINES,
                     tail_bytes: int = TAIL_BYTES, glob: str | None = None) -> DataFrame:
    """(path, value): the last ``lines`` lines of every transcript, each ended by a newline.

    Zero-byte files have an empty value.  Files whose last blocks hold too few
    lines are looked at again over a wider stretch, until all have enough or
    have been seen whole.
    """
    folder = fresh_folder(spark, "tails")
    looks, above = 0, -1
    while True:
        found = tail_lines(spark, path, lines, tail_bytes, above, glob)
        # Larger files than this look has covered may have more lines further up.
        sizes = list_files(spark, path, glob).select(F.col("source_file").alias("path"), "size_bytes")
        judged = sizes.filter(F.col("size_bytes") > above).join(found, "path", "left").withColumn(
            "open", (F.coalesce("n", F.lit(0)) < lines) & (F.col("size_bytes") > tail_bytes))
        judged.write.parquet(f"{folder}/look={looks}")
        seen = spark.read.schema(judged.schema).parquet(f"{folder}/look={looks}")
        if seen.filter("open").isEmpty():
            break
        looks, above, tail_bytes = looks + 1, tail_bytes, tail_bytes * _WIDEN
    every = spark.read.schema(f"{_ddl(judged)}, look INT").parquet(folder)
    # A file's last look counts; one that was closed earlier keeps what it had.
    best = every.groupBy("path").agg(
        F.min_by("tail", F.when(~F.col("open"), F.col("look"))).alias("tail"))
    ended = F.transform("tail", lambda line: F.concat(line, F.lit("\n")))
    return best.select("path", F.coalesce(F.array_join(ended, ""), F.lit("")).alias("value"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)
