"""Quality scores by nearest-neighbour voting in a latent semantic space.

Terms are pairs of neighbouring characters after folding bytes to a few
classes, and shares of repeated words.  A truncated singular value
decomposition of labelled documents gives the latent space.  The labelled
vectors are broadcast; every document is multiplied with all of them in
blocks, and its nearest neighbours vote with their cosine as weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import as_bytes, in_training, slices, texts

# At most so many labelled documents make the space and vote: a stated bound.
SAMPLE = 4096
DIMENSIONS = 48
NEIGHBOURS = 15
THRESHOLD = 0.3
HOLD_OUT = 5
_BLOCK = 256
_REPEATS = 3

# Byte classes: a-z apart, A-Z as one, digits as one, space, line breaks, each
# frequent mark apart, other ASCII, four groups of bytes beyond ASCII.
_MARKS = b".,;:!?'\"()-|#*$%&/@"
_CLASSES = 26 + 4 + len(_MARKS) + 1 + 4
TERMS = _CLASSES * _CLASSES + _REPEATS


def _byte_classes() -> np.ndarray:
    fold = np.full(256, 30 + len(_MARKS), dtype=np.int32)
    fold[ord("a"):ord("z") + 1] = np.arange(26)
    fold[ord("A"):ord("Z") + 1] = 26
    fold[ord("0"):ord("9") + 1] = 27
    fold[ord(" ")] = 28
    fold[[9, 10, 11, 12, 13]] = 29
    for k, mark in enumerate(_MARKS):
        fold[mark] = 30 + k
    for k in range(4):
        fold[128 + 32 * k:160 + 32 * k] = 31 + len(_MARKS) + k
    return fold


_FOLD = _byte_classes()


def term_vector(text: bytes) -> np.ndarray:
    """Square roots of term shares of one whole text; zeros when it is empty."""
    row = np.zeros(TERMS, dtype=np.float32)
    folded = _FOLD[np.frombuffer(text, dtype=np.uint8)]
    if folded.size > 1:
        pairs = np.bincount(folded[:-1] * _CLASSES + folded[1:], minlength=_CLASSES * _CLASSES)
        row[:-_REPEATS] = np.sqrt(pairs / (folded.size - 1))
    words = text.lower().split()
    if words:
        distinct = len(set(words))
        echoes = sum(map(bytes.__eq__, words, words[1:]))
        # How far repetition exceeds what running text of that length shows.
        row[-3] = np.sqrt(echoes / len(words))
        row[-2] = np.sqrt(max(0.0, 1 - distinct / len(words) ** 0.8))
        row[-1] = np.sqrt(min(1.0, np.log1p(max(map(len, words))) / 10))
    return row


@dataclass(frozen=True)
class LatentModel:
    """Term weights and axes of the space, labelled unit vectors and their labels."""

    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def embed(self, rows: np.ndarray) -> np.ndarray:
        dense = rows @ self.axes
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        return dense / np.where(norms > 0, norms, 1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(rows), prior)
        cosine = self.embed(rows) @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = np.clip(np.take_along_axis(cosine, near, 1).astype(np.float64), 0, None) ** 4
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1)
        return np.where(total > 0, vote / np.where(total > 0, total, 1), prior)


def _leading_axes(gram: np.ndarray, dimensions: int, rounds: int = 12) -> np.ndarray:
    """Leading eigenvectors of a Gram matrix by subspace iteration from a fixed start."""
    axes = np.random.default_rng(7).standard_normal((len(gram), dimensions)).astype(np.float32)
    for _ in range(rounds):
        axes, _ = np.linalg.qr(gram @ axes)
    return axes.astype(np.float32)


def fit_latent(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS,
               neighbours: int = NEIGHBOURS) -> LatentModel:
    """The latent space of bounded labelled term rows, by a truncated decomposition."""
    labels = np.asarray(labels, dtype=np.float64)
    rows = np.asarray(rows, dtype=np.float32).reshape(-1, TERMS)
    weight = np.ones(TERMS, dtype=np.float32)
    if len(rows):
        seen = (rows > 0).sum(0)
        weight = (1 + np.log((1 + len(rows)) / (1 + seen))).astype(np.float32)
        weight[-_REPEATS:] *= 2
    weighted = rows * weight
    axes = _leading_axes(weighted.T @ weighted, dimensions) * weight[:, None]
    model = LatentModel(axes, np.zeros((0, dimensions), np.float32), labels, neighbours)
    return LatentModel(axes, model.embed(rows), labels, neighbours)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, _BLOCK):
        rows = [term_vector(t).tobytes() for t in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.binary()), batch.column("quality")], ["terms", "quality"])


def _packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term rows compressed for their way to the driver, as most terms are zero."""
    for batch in batches:
        rows = [zlib.compress(row.as_buffer(), 1) for row in batch.column("terms")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.binary()), batch.column("quality")], ["terms", "quality"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          hold_out: int = HOLD_OUT) -> LatentModel:
    """Fit on at most ``sample`` labelled rows outside the held-out fold.

    The rows with the least hash of their id are taken, whatever the table's
    size.  Several labels of one document: their majority, 1 on a tie.  Null
    labels and ids are ignored.
    """
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(
        in_training(hold_out))
    chosen = (
        usable.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = (
        texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "quality")
        .mapInArrow(_term_batches, "terms binary, quality int")
        .orderBy("terms", "quality").limit(sample)
        .mapInArrow(_packed_batches, "terms binary, quality int").toArrow()
    )
    terms = np.empty((rows.num_rows, TERMS), dtype=np.float32)
    for at, packed in enumerate(rows.column("terms")):
        terms[at] = np.frombuffer(zlib.decompress(packed.as_buffer()), dtype=np.float32)
    return fit_latent(terms, rows.column("quality").to_numpy())


def quality_scores(docs: DataFrame, model: LatentModel, hold_out: int = HOLD_OUT,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document.

    Null and empty texts have no terms and get the share of label 1 among the
    labelled rows, or 0.5 without any.  Repeated rows are scored each; only
    ``doc_id`` and ``text`` are read, and the id only marks the fold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BLOCK):
            rows = np.stack([term_vector(t) for t in as_bytes(batch.column("text"))])
            score = np.clip(shared.value.score(rows), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts(docs).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", (~in_training(hold_out)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: LatentModel, threshold: float = THRESHOLD) -> DataFrame:
    """Documents scored at or above the threshold, all columns as they came.

    Scores are computed beside the rows, so no join and no shuffle is needed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BLOCK):
            plain = batch.column("text").fill_null("")
            rows = np.stack([term_vector(t) for t in as_bytes(plain)])
            yield batch.filter(pa.array(shared.value.score(rows) >= threshold))

    return docs.mapInArrow(run, docs.schema)
