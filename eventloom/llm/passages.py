"""Removal of passages that occur earlier in the corpus, by suffix arrays per shard.

A byte goes when a string of ``WINDOW`` bytes around it also starts earlier:
in a document with a smaller id, or earlier in the same one.

Windows are dealt to shards by content.  Each window is owned by the least
hash among the short strings inside it (leftmost on a tie), a choice that
depends on its bytes alone, so equal windows have equal owners.  Neighbouring
windows of one owner form a run.  Runs that agree in owner and bytes need no
comparison: all but the first are repeats.  Owners whose runs differ go with
their bytes to shards, where an induced suffix array brings equal windows
together and permuted common prefixes tell them apart.  Everything is exact
apart from collisions of 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import as_bytes, drop_stored, free_name, slices, store, texts
from eventloom.llm.suffixes import permuted_common_prefixes, suffix_array

WINDOW = 100
_GRAM = 32
# Windows are hashed in stretches of this many bytes; places take 22 bits beside a hash.
_STRETCH = 1 << 20
_PLACE_BITS = 22
# Runs sent to one shard of the first step, and bytes of one suffix array.
_SHARD_RUNS = 200_000
_SHARD_BYTES = 1_000_000
# Owners with more distinct runs than this are compared by hashes of single windows.
_MANY_RUNS = 2048
_FLUSH_RUNS = 400_000

_RNG = np.random.default_rng(2)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_RUN = np.dtype([("owner", "<u8"), ("body", "<u8"), ("doc", "<i8"), ("low", "<i4"), ("span", "<i4")])


class _Rolling:
    """Hashes of any substring of a buffer from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        n = len(data)
        odd = np.uint64(base | 1)
        back = np.uint64(pow(base | 1, -1, 1 << 64))
        powers = np.ones(n + 1, dtype=np.uint64)
        powers[1:] = odd
        self.inverse = np.ones(n + 1, dtype=np.uint64)
        self.inverse[1:] = back
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stops] - self.sums[starts]) * self.inverse[starts])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _runs(data: np.ndarray, docs: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
          offset: int) -> np.ndarray:
    """Runs of the windows inside each document of one buffer."""
    if len(data) < WINDOW:
        return np.zeros(0, _RUN)
    rolling = _Rolling(data, _BASES[0])
    at = np.arange(len(data) - _GRAM + 1)
    grams = rolling.of(at, at + _GRAM)
    keys = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    owner = (_sliding_least(keys, WINDOW - _GRAM + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    which = np.repeat(np.arange(len(docs)), sizes)[:len(owner)]
    whole = np.arange(len(owner)) + WINDOW <= (starts + sizes)[which]
    opens = np.flatnonzero(whole & np.concatenate((
        [True], (owner[1:] != owner[:-1]) | (which[1:] != which[:-1]))))
    if not opens.size:
        return np.zeros(0, _RUN)
    last_of_doc = (starts + sizes)[which[opens]] - WINDOW
    closes = np.minimum(np.append(opens[1:], len(owner)) - 1, last_of_doc)
    body = rolling.of(opens, closes + WINDOW)
    shape = ((owner[opens] - opens) << 8 | (closes - opens)).astype(np.uint64)
    out = np.empty(len(opens), _RUN)
    out["owner"] = grams[owner[opens]]
    out["body"] = _mixed(body ^ (shape * np.uint64(_BASES[1])))
    out["doc"] = docs[which[opens]]
    out["low"] = opens - starts[which[opens]] + offset
    out["span"] = closes - opens
    return out


def _doc_runs(batches: Iterator[pa.RecordBatch], stretch: int) -> Iterator[np.ndarray]:
    held: list[tuple[int, np.ndarray]] = []
    total = 0

    def buffer() -> np.ndarray:
        sizes = np.array([len(b) for _, b in held])
        return _runs(np.concatenate([b for _, b in held]), np.array([d for d, _ in held]),
                     np.cumsum(sizes) - sizes, sizes, 0)

    for batch in slices(batches):
        for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
            data = np.frombuffer(text, np.uint8)
            if len(data) < WINDOW:
                continue
            if len(data) > stretch:
                for low in range(0, len(data) - WINDOW + 1, stretch):
                    part = data[low:low + stretch + WINDOW - 1]
                    yield _runs(part, np.array([doc]), np.zeros(1, np.int64), np.array([len(part)]), low)
                continue
            if total + len(data) > stretch and held:
                yield buffer()
                held, total = [], 0
            held.append((doc, data))
            total += len(data)
    if held:
        yield buffer()


def _first_of_each(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs sorted by owner, bytes and place, and which are the first of their bytes."""
    runs = runs[np.lexsort((runs["low"], runs["doc"], runs["body"], runs["owner"]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs["owner"][1:] != runs["owner"][:-1]) | (runs["body"][1:] != runs["body"][:-1])
    # A row that repeats its document is that document, not a copy of it.
    head = np.maximum.accumulate(np.where(first, np.arange(len(runs)), 0))
    same = (runs["doc"] == runs["doc"][head]) & (runs["low"] == runs["low"][head]) & ~first
    return runs[~same], first[~same]


_FOUND = ["kind", "shard", "owner", "doc", "low", "high", "runs"]
_FOUND_SCHEMA = "kind int, shard int, owner long, doc long, low int, high int, runs binary"


def _found(kind: int, runs: np.ndarray) -> pa.RecordBatch:
    """Rows of repeats (kind 0) or of runs still to compare (1: by suffixes, 2: by windows)."""
    n = len(runs)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int32()),
        pa.array(runs["owner"].astype(np.int64)), pa.array(runs["doc"]), pa.array(runs["low"]),
        pa.array(runs["low"] + runs["span"]), pa.nulls(n, pa.binary()),
    ], _FOUND)


def _map_runs(shards: int, stretch: int):
    """Runs of a task's documents, equal ones settled there, the first sent to shards."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        runs, first = _first_of_each(np.concatenate(held))
        yield _found(0, runs[~first])
        runs = runs[first]
        shard = (runs["owner"] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        runs, shard = runs[order], shard[order]
        cuts = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(runs)]))
        # Columns one after another, owners first, compress better than rows.
        blobs = [b"".join(np.ascontiguousarray(runs[name][a:b]).tobytes() for name in _RUN.names)
                 for a, b in zip(cuts[:-1], cuts[1:])]
        n = len(blobs)
        if len(runs):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, 9, np.int32)), pa.array(shard[cuts[:-1]].astype(np.int32)),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int32()), pa.array(blobs, pa.binary())], _FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for runs in _doc_runs(batches, stretch):
            held.append(runs)
            total += len(runs)
            if total >= _FLUSH_RUNS:
                yield from flush(held)
                held, total = [], 0
        if held:
            yield from flush(held)

    return run


def _unpacked(blob: bytes) -> np.ndarray:
    n = len(blob) // _RUN.itemsize
    out, at = np.empty(n, _RUN), 0
    for name in _RUN.names:
        size = n * _RUN[name].itemsize
        out[name] = np.frombuffer(blob[at:at + size], _RUN[name])
        at += size
    return out


def _settle_shard(many_runs: int):
    """Repeats among the runs of a shard, and the runs whose owner has differing ones."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("runs").to_pylist()
        runs, first = _first_of_each(np.concatenate([_unpacked(b) for b in blobs]))
        parts = [_found(0, runs[~first])]
        runs = runs[first]
        _, at, variants = np.unique(runs["owner"], return_inverse=True, return_counts=True)
        variants = variants[at]
        parts += [_found(1, runs[(variants > 1) & (variants <= many_runs)]),
                  _found(2, runs[variants > many_runs])]
        return pa.Table.from_batches(parts)

    return run


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of runs to compare by suffixes; hashes of each window of the others."""
    names = ["owner", "doc", "low", "high", "bytes", "left", "right"]
    for batch in slices(batches, 256):
        rows = []
        for doc, text, runs in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")),
                                   batch.column("runs").to_pylist()):
            rolling = None
            for run in runs:
                low, high = run["low"], run["high"]
                if high + WINDOW > len(text):
                    continue
                if run["kind"] == 1:
                    rows.append((run["owner"], doc, low, high, text[low:high + WINDOW], None, None))
                    continue
                if rolling is None:
                    data = np.frombuffer(text, np.uint8)
                    rolling = [_Rolling(data, base) for base in _BASES]
                at = np.arange(low, high + 1)
                for s, left, right in zip(at.tolist(), *[
                        r.of(at, at + WINDOW).view(np.int64).tolist() for r in rolling]):
                    rows.append((None, doc, s, s, None, left, right))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 10_000]), kinds)], names)


def repeated_windows(bodies: list[bytes], docs: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """(row, window) pairs of windows of ``bodies`` whose bytes start at an earlier place.

    The bodies are joined with separators, sorted as suffixes and cut into
    groups wherever neighbours share fewer than a window's bytes.
    """
    sizes = np.array([len(b) for b in bodies])
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int((sizes + 1).sum()), dtype=np.uint16)
    row = np.repeat(np.arange(len(bodies)), sizes + 1)
    inside = np.ones(len(text), dtype=bool)
    inside[starts + sizes] = False
    text[inside] = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint16) + 1
    order = suffix_array(text)
    shared = permuted_common_prefixes(text, order, WINDOW)
    at = np.arange(len(text)) - starts[row]
    window = at + WINDOW <= sizes[row]
    group = np.cumsum(shared[order] < WINDOW)
    keep = window[order]
    order, group = order[keep], group[keep]
    place = np.lexsort((lows[row[order]] + at[order], docs[row[order]], group))
    order, group = order[place], group[place]
    first = np.ones(len(order), dtype=bool)
    first[1:] = group[1:] != group[:-1]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    # The same place seen twice is one occurrence.
    twin = (docs[row[order]] == docs[row[head]]) & (
        lows[row[order]] + at[order] == lows[row[head]] + at[head])
    late = order[~twin]
    return np.stack([row[late], lows[row[late]] + at[late]])


def _compare_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    docs, lows = pdf["doc"].to_numpy(), pdf["low"].to_numpy().astype(np.int64)
    row, at = repeated_windows(pdf["bytes"].tolist(), docs, lows)
    order = np.lexsort((at, docs[row]))
    doc, at = docs[row][order], at[order]
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(opens)
    ends = np.append(first[1:], len(at)) - 1
    return pd.DataFrame({"doc": doc[first], "low": at[first], "high": at[ends[:len(first)]]})


def repeated_ranges(docs: DataFrame, many_runs: int = _MANY_RUNS,
                    stretch: int = _STRETCH) -> DataFrame:
    """(doc, low, high): windows starting at low..high of a document start earlier elsewhere."""
    whole = texts(docs).filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A run starts about every half window of owners.
    shards = max(1, math.ceil(2 * volume / (WINDOW - _GRAM + 2) / _SHARD_RUNS))
    mapped = store(whole.mapInArrow(_map_runs(shards, stretch), _FOUND_SCHEMA), "runs")
    settled = store(
        mapped.filter("kind = 9").groupBy("shard").applyInArrow(_settle_shard(many_runs), _FOUND_SCHEMA)
        .drop("shard", "runs"), "settled")
    early = store(mapped.filter("kind = 0").select("doc", "low", "high"), "early")
    drop_stored(mapped)

    open_runs = settled.filter("kind > 0")
    per_doc = open_runs.groupBy(F.col("doc").alias("doc_id")).agg(
        F.collect_list(F.struct("kind", "owner", "low", "high")).alias("runs"))
    bodies = store(
        whole.join(per_doc, "doc_id").mapInArrow(
            _window_batches,
            "owner long, doc long, low int, high int, bytes binary, left long, right long"), "bodies")
    size = bodies.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    arrays = max(1, math.ceil(size / _SHARD_BYTES))
    by_suffix = (
        bodies.filter("bytes IS NOT NULL")
        .groupBy(F.pmod(F.xxhash64("owner"), F.lit(arrays)).alias("array"))
        .applyInPandas(_compare_shard, "doc long, low int, high int")
    )
    hashed = bodies.filter("bytes IS NULL")
    place = F.struct("doc", "low")
    firsts = hashed.groupBy("left", "right").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    by_window = (
        hashed.join(firsts.filter("n > 1"), ["left", "right"]).filter(place != F.col("first"))
        .select("doc", "low", "high")
    )
    return (
        early.union(settled.filter("kind = 0").select("doc", "low", "high"))
        .union(by_suffix).union(by_window)
    )


def _removed_mask(size: int, spans: list) -> np.ndarray:
    """True for bytes covered by a repeated window."""
    steps = np.zeros(size + 1, dtype=np.int64)
    if spans:
        low = np.array([s["low"] for s in spans])
        high = np.array([s["high"] for s in spans]) + WINDOW
        fits = low < size
        np.add.at(steps, low[fits], 1)
        np.add.at(steps, np.minimum(high[fits], size), -1)
    return np.cumsum(steps)[:size] > 0


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The mask cut back to characters all of whose bytes go, so that the rest is text."""
    lead = (data & 0xC0) != 0x80
    char = np.cumsum(lead) - 1
    stays = np.bincount(char, ~gone, minlength=char[-1] + 1) > 0
    return gone & ~stays[char]


def with_spans(docs: DataFrame, name: str, **limits: int) -> DataFrame:
    """``docs`` with a column ``name``: the repeated ranges of each document."""
    key = free_name(docs, "repeat_doc")
    spans = repeated_ranges(docs, **limits).groupBy(F.col("doc").alias(key)).agg(
        F.collect_list(F.struct("low", "high")).alias(name))
    return docs.join(spans, F.col("doc_id").cast("long") == F.col(key), "left").drop(key)


def removal_report(docs: DataFrame, **limits: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): one row per document.

    Null texts count as empty; texts below the window's length keep all bytes.
    Of equal texts the one with the least ``doc_id`` stays whole.  A row that
    repeats an id is the same document, so neither makes the other a repeat.
    Rows without an id keep all bytes.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = []
            for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                data = np.frombuffer(text, np.uint8)
                gone = _removed_mask(len(data), spans or [])
                opens = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(data), int(gone.sum()), opens,
                             hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in zip(*rows)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(texts(docs), "spans", **limits).select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Documents with repeated passages taken out of ``text`` and ``n_chars`` set anew.

    All rows and columns stay.  Only whole characters go, so that the rest is
    valid text; a null text stays null.
    """
    names = docs.columns
    schema = docs.schema
    added = free_name(docs, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            out, counts = [], []
            column = batch.column("text")
            for text, spans in zip(as_bytes(column), batch.column(added).to_pylist()):
                if text is not None and spans:
                    data = np.frombuffer(text, np.uint8)
                    gone = _removed_mask(len(data), spans)
                    if gone.any():
                        text = data[~_whole_characters(data, gone)].tobytes()
                out.append(None if text is None else text.decode())
                counts.append(None if text is None else len(out[-1]))
            cells = {name: batch.column(name) for name in names}
            cells["text"] = pa.array(out, column.type)
            if "n_chars" in cells:
                cells["n_chars"] = pa.array(counts, batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([cells[n] for n in names], names)

    return with_spans(docs, added).select(*names, added).mapInArrow(run, schema)
