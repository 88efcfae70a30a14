"""SentencePiece BPE with seeded merge-dropout, and its lossless decoding.

Merges are taken from an agenda by score; a candidate that a keyed hash marks
is skipped.  The key is the seed, the document, the run's place in it and the
candidate's turn on the agenda, so every occurrence of a word draws anew, and a
document always gets the same pieces under one seed and others under another.

What is remembered of a run depends on the run and its skipped turns only: the
pieces after given skips when nothing else is skipped, and the turns they take.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from eventloom.llm.common import slices, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SEED = 20
RATE = 0.1
# Turns of a run that are drawn for a whole text at once, two per hash.
_TURNS = 16
_MEMO = 300_000
_LONG = 200
_NEVER = 1 << 60
_STEP = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1
_BLANK = "▁"
# Stands for a block sign of the text; no piece contains it.
_LITERAL = "\ud800"
_RUNS = regex.compile(r" *[^ ]+| +")


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class DropoutCodec:
    """Encoder and decoder over the pieces of one model."""

    def __init__(self, path: str = MODEL, seed: int = SEED, rate: float = RATE) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids = {model.id_to_piece(i): i for i in range(size)
                    if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        order = sorted(self.ids, key=lambda piece: -model.get_score(self.ids[piece]))
        self.ranks = {piece: rank for rank, piece in enumerate(order)}
        byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_ids = byte
        self.surface = [b""] * size
        for piece, i in self.ids.items():
            self.surface[i] = piece.replace(_BLANK, " ").encode()
        for b, i in enumerate(byte):
            self.surface[i] = bytes([b])
        self.seed = seed
        self.limit = int(rate * (1 << 32))
        # (run, turns skipped as bits) -> (turns taken, ids) if no other turn is skipped.
        self.memo: dict[tuple[str, int], tuple[int, bytes]] = {}

    def _starts(self, doc_id: object, runs: int) -> np.ndarray:
        """A hash for each run of a document, by its place."""
        key = xxhash.xxh64_intdigest(str(doc_id), self.seed)
        return _mixed(np.uint64(key) + np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(_STEP))

    def _draws(self, start: np.ndarray, first: int, turns: int) -> np.ndarray:
        """Whether each of ``turns`` turns from ``first`` on is skipped; both are even."""
        at = np.arange(first // 2 + 1, (first + turns) // 2 + 1, dtype=np.uint64)
        hashes = _mixed(start[:, None] + at * np.uint64(_STEP))
        return hashes.view("<u4").reshape(len(start), turns) < self.limit

    def _further(self, start: np.uint64, first: int, turns: int) -> int:
        """Skipped turns of one run as bits, for turns after those of the whole text."""
        turns += turns % 2
        drawn = self._draws(np.array([start], dtype="<u8"), first, turns)[0]
        return int.from_bytes(np.packbits(drawn, bitorder="little").tobytes(), "little") << first

    def _spell(self, parts: list[str]) -> list[int]:
        """Ids of the final parts; what has no piece is spelled in bytes."""
        out: list[int] = []
        for part in parts:
            piece = self.ids.get(part)
            if piece is None:
                text = _BLANK if part == _LITERAL else " " if part == _BLANK else part
                out += [self.byte_ids[b] for b in text.encode()]
            else:
                out.append(piece)
        return out

    def run_ids(self, run: str, skips: int = 0) -> tuple[int, list[int]]:
        """Turns taken and ids of one run (its blanks and the characters up to the next blank).

        Bit t of ``skips`` says that the candidate of turn t is skipped.  The
        agenda of a short run is a list with the rank of the merge at each
        place; that of a long one is a heap, so that its time stays near linear.
        A literal block sign takes part in no merge, or it would be read back
        as a blank.
        """
        if _BLANK in run:
            run = run.replace(_BLANK, _LITERAL)
        parts = list(run.replace(" ", _BLANK))
        if len(parts) > _LONG:
            turn, parts = self._merge_long(parts, lambda t: skips >> t & 1)
            return turn, self._spell(parts)
        rank = self.ranks.get
        agenda = [rank(x + y, _NEVER) for x, y in zip(parts, parts[1:])]
        turn = -1
        while agenda and (best := min(agenda)) != _NEVER:
            at = agenda.index(best)
            turn += 1
            if skips >> turn & 1:
                agenda[at] = _NEVER
                continue
            parts[at] += parts.pop(at + 1)
            del agenda[at]
            if at < len(agenda):
                agenda[at] = rank(parts[at] + parts[at + 1], _NEVER)
            if at:
                agenda[at - 1] = rank(parts[at - 1] + parts[at], _NEVER)
        return turn + 1, self._spell(parts)

    def _merge_long(self, parts: list[str], skipped) -> tuple[int, list[str]]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            rank = self.ranks.get(parts[a] + parts[b], _NEVER)
            if rank != _NEVER:
                heapq.heappush(agenda, (rank, a, len(parts[a]), len(parts[b])))

        for k in range(n - 1):
            propose(k, k + 1)
        turn = -1
        while agenda:
            rank, a, left, right = heapq.heappop(agenda)
            b = after[a]
            if b >= n or len(parts[a]) != left or len(parts[b]) != right:
                continue
            turn += 1
            if skipped(turn):
                continue
            parts[a] += parts[b]
            parts[b] = ""
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                propose(a, after[a])
            if before[a] >= 0:
                propose(before[a], a)
        return turn + 1, [part for part in parts if part]

    def _long_ids(self, run: str, start: np.uint64) -> bytes:
        """Ids of a run too long to be remembered; turns are drawn in stretches."""
        drawn: list[bool] = []
        one = np.array([start], dtype="<u8")

        def skipped(turn: int) -> bool:
            if turn >= len(drawn):
                drawn.extend(self._draws(one, len(drawn), 1024)[0].tolist())
            return drawn[turn]

        parts = list(run.replace(_BLANK, _LITERAL).replace(" ", _BLANK))
        return np.array(self._spell(self._merge_long(parts, skipped)[1]), dtype="<u4").tobytes()

    def _remembered(self, key: tuple[str, int]) -> tuple[int, bytes]:
        turns, ids = self.run_ids(*key)
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        found = self.memo[key] = turns, np.array(ids, dtype="<u4").tobytes()
        return found

    def encode(self, text: str, doc_id: object = 0) -> np.ndarray:
        """Ids of a whole text; a blank is put before it, as the model expects."""
        if not text:
            return np.zeros(0, dtype="<u4")
        recall, packed = self.memo.get, []
        runs = _RUNS.findall(" " + text)
        starts = self._starts(doc_id, len(runs))
        drawn = np.packbits(self._draws(starts, 0, _TURNS), axis=1, bitorder="little")
        for place, (run, skips) in enumerate(zip(runs, drawn.view("<u2").ravel().tolist())):
            if len(run) > _LONG:
                packed.append(self._long_ids(run, starts[place]))
                continue
            known, past = _TURNS, 0
            while True:
                key = (run, past)
                turns, ids = recall(key) or self._remembered(key)
                if turns > known:
                    skips |= self._further(starts[place], known, turns - known)
                    known = turns + (turns - known) % 2
                left = (skips & ((1 << turns) - 1)) ^ past
                if not left:
                    break
                past |= left & -left
            packed.append(ids)
        return np.frombuffer(b"".join(packed), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids from ``encode``, under whatever seed and rate."""
        return b"".join(map(self.surface.__getitem__, ids.tolist())).decode()[1:]


def _code_batches(path: str, seed: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = DropoutCodec(path, seed, rate)
        for batch in slices(batches, 256):
            docs = batch.column("doc_id")
            coded = [codec.encode(t, d) for t, d in zip(
                batch.column("text").to_pylist(), docs.to_pylist())]
            yield pa.RecordBatch.from_arrays([docs, _id_lists(coded)], ["doc_id", "ids"])

    return run


def _id_lists(coded: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(c) for c in coded]).astype(np.int32)
    flat = np.concatenate(coded) if coded else np.zeros(0, "<u4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, model: str = MODEL, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """(doc_id, ids): every whole text as piece ids.

    Null and empty texts have no ids; repeated rows are encoded alike; other
    columns are not read.  Characters without a piece become bytes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        _code_batches(model, seed, rate), f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows from ``encode``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = DropoutCodec(model)
        for batch in slices(batches, 256):
            back = [codec.decode(np.array(i or [], dtype="<u4")) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(back, pa.string())], ["doc_id", "text"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: str = MODEL, seed: int = SEED,
               rate: float = RATE) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_crc32, lossless) of every whole text.

    ``ids_crc32`` is over the ids
    as little-endian 32-bit numbers, ``lossless`` says that decoding gives the
    text again.  Encoding and decoding share one pass over the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = DropoutCodec(model, seed, rate)
        for batch in slices(batches, 256):
            docs, source = batch.column("doc_id"), batch.column("text").to_pylist()
            coded = [codec.encode(t, d) for t, d in zip(source, docs.to_pylist())]
            yield pa.RecordBatch.from_arrays([
                docs, _id_lists(coded),
                pa.array([len(c) for c in coded], pa.int64()),
                pa.array([zlib.crc32(c.tobytes()) for c in coded], pa.int64()),
                pa.array([codec.decode(c) == t for c, t in zip(coded, source)], pa.bool_()),
            ], ["doc_id", "ids", "n_tokens", "ids_crc32", "lossless"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_tokens long, ids_crc32 long, lossless boolean")
