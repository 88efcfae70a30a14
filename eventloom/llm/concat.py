"""Concatenate-and-cut packing.

All token streams follow each other in one global order and are cut at every
``SEQUENCE`` tokens, so only the last sequence can be short.  The first pass
tokenizes each partition and keeps every text's place in it; prefix sums over
the partitions' totals place the partitions; the second pass cuts each text at
the fixed windows its global place implies.  Windows that one piece does not
fill are made of boundary records, which meet by the window's number.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm.common import texts
from eventloom.llm.prefix import portions, totals_before, with_totals, written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 1
SEQUENCE = 2048
_ID_BYTES = 4


class Ids:
    """Ids of whole texts, as little-endian 32-bit bytes.

    The vocabulary's ranks give the ids of plain text; both spell every code
    point alike.  Only a text that names one of the vocabulary's special tokens
    goes through its full definition, which alone knows them.
    """

    def __init__(self, tokenizer: str, ranks: str) -> None:
        self.whole = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(name in text for name in self.special):
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids)
        else:
            ids = self.plain.encode_to_numpy(text)
        return ids.astype("<u4").tobytes()


@cache
def _ids(tokenizer: str, ranks: str) -> Ids:
    """One vocabulary per worker."""
    return Ids(tokenizer, ranks)


def _token_batches(tokenizer: str, ranks: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = _ids(tokenizer, ranks), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in portions(batches, "text"):
            ids = [encoder.encode(t) + end for t in batch.column("text").to_pylist()]
            sizes = np.array([len(i) // _ID_BYTES for i in ids], dtype=np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start = int(starts[-1] + sizes[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(ids), pa.int64()), pa.array(starts),
                 pa.array(sizes), pa.array(ids, pa.binary())],
                ["doc_id", "part", "place", "doc_tokens", "ids"])

    return run


def token_streams(docs: DataFrame, tokenizer: str = TOKENIZER, ranks: str = RANKS,
                  end_id: int = END_ID) -> DataFrame:
    """(doc_id, part, place, doc_tokens, ids): each text's ids and the end id, stored.

    ``tokenizer`` and ``ranks`` are the two files of one vocabulary.  ``place`` counts the tokens before it in its partition.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(texts(docs).mapInArrow(
        _token_batches(tokenizer, ranks, end_id),
        f"doc_id {kind}, part long, place long, doc_tokens long, ids binary"), "streams")


def placed(streams: DataFrame) -> DataFrame:
    """(doc_id, doc_tokens, ids, at): streams with their place in the whole concatenation."""
    sizes = streams.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    return with_totals(streams, totals_before(sizes, "n")).select(
        "doc_id", "doc_tokens", "ids", (F.col("before") + F.col("place")).alias("at"))


def cut(streams: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """(doc_id, doc_tokens, start, length, sequence_id, offset, ids): one row per piece.

    Input as from ``placed``.  The pieces of a text are made in one pass over
    its ids, so a very long text costs no more than its length.
    """
    at, total = F.col("at"), F.col("doc_tokens")

    def piece(window: Column) -> Column:
        begin = F.greatest(window * size, at)
        length = F.least((window + 1) * size, at + total) - begin
        start = begin - at
        return F.struct(
            start.alias("start"), length.alias("length"), window.alias("sequence_id"),
            (begin - window * size).alias("offset"),
            F.substring("ids", (start * _ID_BYTES + 1).cast("int"), (length * _ID_BYTES).cast("int"))
            .alias("ids"))

    windows = F.sequence(F.floor(at / size), F.floor((at + total - 1) / size))
    return streams.select("doc_id", "doc_tokens", F.inline(F.transform(windows, piece)))


def sequences(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, ids as 32-bit bytes.

    A piece that fills its window is a sequence already.  The others are
    boundary records: they are grouped by window, at most ``size`` to a group.
    """
    full = F.col("length") == size
    record = F.struct("offset", "ids")
    joined = pieces.filter(~full).groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(record)).alias("records"))
    ids = F.aggregate("records", F.lit(b""), lambda done, r: F.concat(done, r["ids"]))
    return pieces.filter(full).select("sequence_id", "length", "ids").union(
        joined.select("sequence_id", "length", ids))


def cut_pieces(docs: DataFrame, size: int = SEQUENCE, tokenizer: str = TOKENIZER,
               ranks: str = RANKS) -> DataFrame:
    """One row per piece of every document, as from ``cut``.

    Null and empty texts are the end id alone; repeated rows and rows without
    id are packed each; only ``doc_id`` and ``text`` are read, so other columns
    may have any name.  No documents give no rows.  One text's ids must fit
    2 GB.  Padding is at most ``size`` - 1 in the whole result.
    """
    return cut(placed(token_streams(docs, tokenizer, ranks)), size)
