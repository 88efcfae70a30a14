"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.workdir import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Free the shuffle files of finished steps now.

    Spark deletes them once the driver's collector has found their owners
    dead, which it may not do for half an hour.
    """
    spark._jvm.System.gc()


def store(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here.

    A lost executor or a second use reads the stored rows instead of running
    the work again.  Without a ``codec`` the session's compression holds.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    release(spark)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def drop_stored(df: DataFrame) -> None:
    """Delete a table written by ``store`` that nothing will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, whole ``text`` (null: empty) and the named further columns."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches cut to a bounded number of rows, so Python holds few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_training(modulus: int):
    """Column: the row may be learned from (crc32 of its id's text is not 0 mod ``modulus``).

    A null id counts as remainder 0.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % modulus
    return F.coalesce(rest != 0, F.lit(False))
