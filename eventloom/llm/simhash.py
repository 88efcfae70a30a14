"""SimHash near-duplicates through covering locality-sensitive hashing.

A text becomes a 64-bit fingerprint; fingerprints that differ in at most
``RADIUS`` bits are linked.  ``covering_masks`` gives 2^(radius+1) - 1 bit
masks with a guarantee instead of a probability: bit i carries a vector m(i)
of radius+1 bits, mask v keeps the bits with an odd number of common ones in
m(i) and v.  The vectors of at most ``radius`` differing bits span less than
the whole space, so some v is orthogonal to all of them, and under mask v the
two fingerprints are equal: every pair within the radius meets in a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import as_bytes, slices, store, texts
from eventloom.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
# Members of a bucket that one comparison block may hold on each side.
BLOCK = 4096

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = (256 * np.arange(8)).astype(np.int64)


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks as unsigned integers, one table each."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(bits)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, size + 1)
    ]


def shingles(text: bytes, width: int = SHINGLE) -> list[bytes]:
    """Space-joined runs of ``width`` lower-cased words; fewer words: all of them."""
    words = text.lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1:] - 1).tolist()
    return [line[a:b] for a, b in zip(starts, stops)]


def majority(hashes: np.ndarray) -> int:
    """Bit b is 1 when more than half of the hashes have it."""
    if not hashes.size:
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
    ones = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    bits = np.packbits(ones.ravel() * 2 > hashes.size, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: bytes) -> int:
    """The majority of the shingle hashes."""
    digest, seed = xxhash.xxh64_intdigest, SEED
    return majority(np.array([digest(s, seed) for s in shingles(text)], dtype="<u8"))


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        marks = np.array([fingerprint(t) for t in as_bytes(batch.column("text"))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "mark"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark): the fingerprint of every whole text as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(_fingerprint_batches, f"doc_id {kind}, mark long")


def _forest(bucket: np.ndarray, mark: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Row pairs that join the linked rows of each bucket; rows are sorted by bucket.

    Compares rows at growing distance.  Only pairs not yet joined are kept, so
    a dense bucket yields one pair per row, not one per link.
    """
    n = len(bucket)
    parent = np.arange(n)
    found: list[tuple[int, int]] = []
    at, gap = np.arange(n), 0
    while True:
        gap += 1
        at = at[at + gap < n]
        at = at[bucket[at] == bucket[at + gap]]
        if not at.size:
            return found
        near = np.bitwise_count(mark[at] ^ mark[at + gap]) <= radius
        left = at[near]
        fresh = left[parent[left] != parent[left + gap]]
        if not fresh.size:
            continue
        for i in fresh.tolist():
            a, b = i, i + gap
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((i, i + gap))
        while (flat := parent[parent]).tolist() != parent.tolist():
            parent = flat


def _link_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(rows: np.ndarray) -> pa.RecordBatch:
            pairs = np.array(_forest(rows[0], rows[1], radius), dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[2][pairs[:, 0]]), pa.array(rows[2][pairs[:, 1]])], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            held.append(rows)
            # The last bucket may go on in the next batch.
            if rows[0][0] == rows[0][-1] and held[0][0][0] == rows[0][0]:
                continue
            rows = np.concatenate(held, axis=1)
            cut = np.searchsorted(rows[0], rows[0][-1])
            yield emit(rows[:, :cut])
            held = [rows[:, cut:]]
        if held:
            yield emit(np.concatenate(held, axis=1))

    return run


def near_links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): pairs of ``node`` that join all linked nodes; input (node, mark), marks distinct.

    Buckets are counted first.  One with more than ``BLOCK`` members is cut
    into chunks and every pair of chunks is compared in a task of its own, so
    no task holds an unbounded bucket and no pair is left out.  Spark sizes the
    rows of all masks as if there were one mask, so the join asks for a merge:
    broadcast, they would fill the driver.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    keyed = marks.select(
        "node", "mark",
        F.posexplode(F.array([F.col("mark").bitwiseAND(F.lit(m)) for m in signed]))
        .alias("mask", "masked"),
    ).select("node", "mark", F.xxhash64("mask", "masked").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    blocks = (
        keyed.hint("merge").join(shared, "bucket")
        .withColumns({"chunks": chunks, "own": F.pmod(F.xxhash64("mark"), chunks)})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.when(F.col("chunks") == 1, F.col("bucket")).otherwise(
                F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
            ).alias("bucket"),
            "mark", "node",
        )
    )
    return (
        blocks.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_link_batches(radius), "u long, v long")
    )


def simhash_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, mark, component_id): one row per document.

    Words are runs of anything but ASCII white space after lower-casing A-Z;
    texts without words have fingerprint 0 and are linked like any other.
    ``component_id`` is the least ``doc_id`` reachable.  Null texts count as
    empty; rows that repeat a document stay; a null ``doc_id`` is kept, but
    never names a component.  Other columns are not read.  Equal fingerprints
    are merged before the search, so copies cost one row.
    """
    marks = store(fingerprints(docs), "marks")
    nodes = store(marks.groupBy("mark").agg(F.min("doc_id").alias("node")), "nodes")
    links = near_links(nodes.filter("node IS NOT NULL"), radius)
    roots = components(links, "u", "v")
    named = nodes.hint("merge").join(roots, "node", "left").select(
        "mark", F.coalesce("root", "node").alias("component_id"))
    return marks.hint("merge").join(named, "mark").select("doc_id", "mark", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Documents with one left of each component, that with the least ``doc_id``.

    Rows without a ``doc_id`` stay; of rows that repeat a kept id one stays.
    """
    found = simhash_components(docs, radius)
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.union(docs.filter("doc_id IS NULL"))
