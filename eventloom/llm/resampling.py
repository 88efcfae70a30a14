"""Importance resampling towards a target distribution.

Texts become bags of hashed word n-grams.  A bucket's gain is the log ratio of
its frequencies in the target and in the corpus; a text's weight is the sum of
its gains, and keyed Gumbel noise turns the highest scores into a draw without
replacement whose odds follow the weights.

N-grams are never spelled out.  Arrow lower-cases and splits whole batches and
numbers the distinct words; the numbers shifted by one word form pairs, the
distinct pairs are numbered again, and shifted once more they form triples.  The
CRC of a distinct pair continues that of its left part by a blank and the word.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.prefix import portions, ranked, written

# All ASCII characters that are not letters or digits part words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 3
BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
SHARE_PERCENT = 5
SCALE = 1000


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row each word comes from, and the words; null and wordless texts give none."""
    listed = pc.split_pattern_regex(pc.ascii_lower(texts), WORD_GAP)
    words, rows = pc.list_flatten(listed), pc.list_parent_indices(listed)
    # A gap at either end of a text leaves an empty string there.
    real = pc.not_equal(words, "")
    return pc.filter(rows, real).to_numpy(zero_copy_only=False).astype(np.int64), pc.filter(words, real)


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = pc.dictionary_encode(values)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def ngram_crcs(rows: np.ndarray, words: pa.Array, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, CRC-32) of every run of 1 to ``width`` words within a row, a length at a time."""
    index, spelled = _numbered(words)
    blank_word = [b" " + w for w in spelled.cast(
        pa.large_binary() if pa.types.is_large_string(spelled.type) else pa.binary()).to_pylist()]
    crcs = np.array([zlib.crc32(w[1:]) for w in blank_word], dtype=np.int64)
    start, gram = np.arange(len(index)), index
    for length in range(1, width + 1):
        if length > 1:
            inside = start + (length - 1) < len(index)
            start, gram = start[inside], gram[inside]
            inside = rows[start] == rows[start + (length - 1)]
            start, gram = start[inside], gram[inside]
            pairs = pa.array(gram << 32 | index[start + (length - 1)])
            gram, distinct = _numbered(pairs)
            codes = distinct.to_numpy(zero_copy_only=False)
            crcs = np.fromiter(
                (zlib.crc32(blank_word[word], crc) for crc, word in zip(
                    crcs[codes >> 32].tolist(), (codes & 0xFFFFFFFF).tolist())),
                dtype=np.int64, count=len(codes))
        yield rows[start], crcs.take(gram)


def _count_batches(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in portions(batches, "text"):
            for _, crcs in ngram_crcs(*split_words(batch.column("text")), width):
                counts += np.bincount(crcs % buckets, minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), pa.array(counts[met], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """(bucket, n): n-grams of all whole texts per bucket, counted in the tasks before the shuffle."""
    return (
        texts.select("text").mapInArrow(_count_batches(buckets, width), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    )


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS,
                 width: int = WIDTH) -> np.ndarray:
    """The gain of every bucket: ``SCALE`` times its log frequency ratio with add-one smoothing.

    ``buckets`` pairs of counts reach the driver, however large the corpus is.
    """
    both = bucket_counts(corpus, buckets, width).select("bucket", "n", F.lit(0).alias("t")).union(
        bucket_counts(target, buckets, width).select("bucket", F.lit(0), "n"))
    found = {r.bucket: (r.n, r.t) for r in both.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")).collect()}
    counts = [found.get(b, (0, 0)) for b in range(buckets)]
    in_corpus, in_target = (sum(c) for c in zip(*counts))
    return np.array([
        math.floor(SCALE * math.log(
            ((t + 1) * (in_corpus + buckets)) / ((s + 1) * (in_target + buckets))))
        for s, t in counts], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """``SCALE`` times a standard Gumbel draw, a function of the seed and the id alone."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    drawn = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _weigh_batches(gains: np.ndarray, seed: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            rows, words = split_words(batch.column("text"))
            features = np.zeros(batch.num_rows, dtype=np.int64)
            weights = np.zeros(batch.num_rows, dtype=np.int64)
            n_words = np.bincount(rows, minlength=batch.num_rows)
            for owner, crcs in ngram_crcs(rows, words, width):
                if not len(owner):
                    continue
                heads = np.flatnonzero(np.diff(owner, prepend=-1))
                weights[owner[heads]] += np.add.reduceat(gains.take(crcs % len(gains)), heads)
                features += np.bincount(owner, minlength=batch.num_rows)
            drawn = np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (
                    n_words, features, weights, weights + drawn))],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def weights(docs: DataFrame, gains: np.ndarray, seed: int = SEED, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _weigh_batches(gains, seed, width),
        f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE_PERCENT,
              least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    ``rank`` numbers the drawn documents from 1 by falling score, ties by
    smaller id and a null id last; it is null for all others.  Drawn are
    ``share`` per cent, rounded down, of the documents with ``least_words``
    words or more.  Null, empty and wordless texts have no features and weight 0;
    a null id draws its noise from the empty name.  Rows that repeat an id are
    documents of their own; equal rows share their score and take successive
    ranks.  An empty target leaves only the corpus's own frequencies, no
    documents give no rows.  Other columns are not read.
    """
    rows = written(weights(docs, bucket_gains(docs, target), seed), "weights")
    able = F.col("n_words") >= least_words
    best = ranked(rows.filter(able), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    drawn = share * rows.filter(able).count() // 100
    return best.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).union(
        rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def selected(docs: DataFrame, target: DataFrame, share: int = SHARE_PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents themselves, with all their columns.

    Every row that carries a drawn id is returned; rows without id are not.
    """
    drawn = resampled(docs, target, share, least_words, seed).filter("rank IS NOT NULL")
    return docs.join(drawn.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
