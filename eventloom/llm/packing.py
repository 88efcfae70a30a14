"""Vector best-fit packing of tokenized documents into sequences.

A bin has three residual capacities: tokens, documents and attention cost (the
sum of squared piece lengths).  Pieces go in by decreasing size; among the
open bins that can take a piece under every constraint, the weighted residual
norm after placement (or the weighted dot product of piece and residual)
selects one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm.common import slices, store, texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SEQUENCE = 4096
# About so many pieces are packed together; one part-filled bin per shard is lost at most.
SHARD_PIECES = 8192
_MEMO = 400_000
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Up to this point characters are letters, digits or marks without combining forms.
_WIDE = regex.compile(r"[^\x20-\x7e\n¡-įı-ɏ]")


# Marks that often end a run of letters; the splitting leaves them apart from it.
_ENDS = frozenset(",.;:!?")
_SHORT = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    return _SHORT[len(ids)](*ids) if len(ids) < len(_SHORT) else struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte without a visible Latin-1 sign as the next sign from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(hidden)}


class ChunkEncoder(dict):
    """Ids, as little-endian 32-bit bytes, of a run of text without blanks.

    The vocabulary's rules never join characters across white space, so a text
    is the concatenation of its runs.  Runs recur, so they are remembered; the
    memory is emptied at a fixed size.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.parts: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def __missing__(self, run: str) -> bytes:
        if len(self) >= _MEMO:
            self.clear()
        if run.isascii() and run.isalpha():
            packed = self.part(run.lower())
        elif "<|" in run or _WIDE.search(run):
            packed = _packed(self.full.encode(run, add_special_tokens=False).ids)
        elif run.isalpha():
            packed = self.part(run.lower())
        elif run[-1:] in _ENDS and run[:-1].isalpha():
            packed = self.part(run[:-1].lower()) + self.part(run[-1])
        else:
            packed = b"".join(map(self.part, _PARTS.findall(run.lower())))
        self[run] = packed
        return packed

    def part(self, word: str) -> bytes:
        """Ids of a lower-cased part that the vocabulary's splitting leaves whole."""
        packed = self.parts.get(word)
        if packed is None:
            if len(self.parts) >= _MEMO:
                self.parts.clear()
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            packed = _packed([token.id for token in self.model.tokenize(spelled)])
            self.parts[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if "<|" not in text and (text.isascii() or not _WIDE.search(text)):
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def _encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a worker, so that its vocabulary is read once and later tasks find known runs."""
    return ChunkEncoder(path)


def _piece_batches(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = _packed([end_id])
        for batch in slices(batches):
            rows: list[tuple] = []
            which: list[int] = []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    rows.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    which.append(k)
            columns = [pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(which)), *columns],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, size: int = SEQUENCE, tokenizer: str = TOKENIZER,
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the end id, cut at ``size``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        _piece_batches(tokenizer, size, end_id),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence, and the weight of each in the choice of a bin."""

    tokens: int = SEQUENCE
    documents: int = SEQUENCE
    attention: int = SEQUENCE * SEQUENCE
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    rule: str = "norm"

    @property
    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity()) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece.

    Ties go to the oldest bin.  A piece that fits no empty bin raises.
    """
    limits = capacity.limits
    weights = np.asarray(capacity.weights)
    demand = np.stack([lengths, np.ones(len(lengths)), np.square(lengths, dtype=np.float64)], axis=1)
    if len(demand) and (demand > limits).any():
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    left = np.empty((64, 3))
    names = np.empty(64, dtype=np.int64)
    used = made = 0
    shares = demand / limits
    for i in np.argsort(-lengths, kind="stable"):
        rest = left[:used] - demand[i]
        able = np.flatnonzero(rest[:, 0] >= 0)
        able = able[(rest[able, 1:] >= 0).all(axis=1)]
        if able.size:
            if capacity.rule == "norm":
                cost = np.square(rest[able] / limits) @ weights
            else:
                cost = -(left[able] / limits * shares[i]) @ weights
            at = able[np.argmin(cost)]
        else:
            if used == len(left):
                left = np.concatenate([left, np.empty_like(left)])
                names = np.concatenate([names, np.empty_like(names)])
            at = used
            left[at], names[at] = limits, made
            used, made = used + 1, made + 1
        bins[i] = names[at]
        offsets[i] = capacity.tokens - int(left[at, 0])
        left[at] -= demand[i]
        if left[at].min() < 1:
            # Full: close it and keep the open bins in order of age.
            left[at:used - 1] = left[at + 1:used]
            names[at:used - 1] = names[at + 1:used]
            used -= 1
    return bins, offsets


def _pack_shard(capacity: Capacity, columns: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # A fixed order makes a repeated task give the same sequences.
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity)
        shard = rows["shard"].to_numpy()
        return rows.assign(sequence_id=(shard << 32) + bins, offset=offsets)[columns]

    return run


def pack(pieces: DataFrame, capacity: Capacity = Capacity(),
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; input as from ``token_pieces``, stored.

    The number of shards follows the number of pieces, so a task packs a
    bounded number of them; a hash of the piece spreads them, whatever their
    source.  Pieces of full length fill a sequence alone within their shard.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    keyed = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    columns = [*pieces.columns, "sequence_id", "offset"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return keyed.groupBy("shard").applyInPandas(
        _pack_shard(capacity, columns), f"{schema}, sequence_id long, offset long")


def packed_sequences(docs: DataFrame, capacity: Capacity = Capacity(),
                     tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece of every document, with its sequence and place.

    Null and empty texts are one piece holding the end id; repeated rows are
    packed each; only ``doc_id`` and ``text`` are read, so other columns may
    have any name.  No documents give no rows.
    """
    pieces = store(token_pieces(docs, capacity.tokens, tokenizer), "pieces")
    return pack(pieces, capacity)
