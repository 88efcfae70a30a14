"""A hidden Markov language model trained by Baum-Welch over partitions.

A token is the word of a class: a latent state emits a class, and the class a
word, P(word | state) = P(class | state) P(word | class).  The most frequent
words are classes of their own, other words share one by their last bytes, and
the end of a text is a class.  So the model's tables are bounded whatever the
vocabulary; the word counts behind P(word | class) cover the whole corpus and
are joined to the texts by word, never broadcast.

Texts are tokenized once into stored blocks with a local vocabulary each, so
that a word travels once per block and not once per occurrence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import as_bytes, drop_stored, in_training, slices, store, texts

HOLD_OUT = 10
STATES = 8
# Classes: the most frequent words, the endings of the others, the end.
COMMON_WORDS = 2000
ENDINGS = 1024
ROUNDS = 2
# Rounds over the counts of neighbouring classes, of which there are at most the classes squared.
START_ROUNDS = 12
BLOCK_DOCS = 8192
BLOCK_BYTES = 24 << 20
# Training cuts longer texts into stretches of this many tokens; scoring never cuts.
STRETCH = 1024
_STRETCH_TOKENS = 250_000
PRIOR = 0.1
# No word holds a blank, so this stands for the end of a text in the counts.
END = " "


class _Numbering(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_ids", "training", "sizes", "tokens", "words"]

    def block(ids, training, tokens, vocab) -> pa.RecordBatch:
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
        cells = [
            pa.array([ids], pa.list_(kind)),
            pa.array([np.array(training, np.uint8).tobytes()], pa.binary()),
            pa.array([np.array([len(t) for t in tokens], np.int32).tobytes()], pa.binary()),
            pa.array([flat.tobytes()], pa.binary()),
            pa.array([b" ".join(vocab)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(cells, names)

    kind = None
    ids: list = []
    training: list = []
    tokens: list[np.ndarray] = []
    vocab, held = _Numbering(), 0
    for batch in slices(batches):
        kind = batch.column("doc_id").type
        for doc, learn, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("training").to_pylist(),
                                    as_bytes(batch.column("text"))):
            words = text.lower().split()
            ids.append(doc)
            training.append(learn)
            tokens.append(np.fromiter(map(vocab.__getitem__, words), np.int32, len(words)))
            held += len(text)
            if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                yield block(ids, training, tokens, vocab)
                ids, training, tokens, vocab, held = [], [], [], _Numbering(), 0
    if ids:
        yield block(ids, training, tokens, vocab)


def token_blocks(docs: DataFrame, hold_out: int = HOLD_OUT) -> DataFrame:
    """Stored blocks of tokenized documents, each row with a number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).withColumn("training", in_training(hold_out)).mapInArrow(
        _block_batches,
        f"doc_ids array<{kind}>, training binary, sizes binary, tokens binary, words binary")
    # Numbers of a small local vocabulary: most of their bytes are zero.
    return store(rows.withColumn("block", F.monotonically_increasing_id()), "blocks", "zstd")


@dataclass
class Block:
    """One unpacked row of ``token_blocks``."""

    training: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    words: list[bytes]

    @classmethod
    def of(cls, training: bytes, sizes: bytes, tokens: bytes, words: bytes) -> Block:
        return cls(np.frombuffer(training, np.uint8).astype(bool), np.frombuffer(sizes, np.int32),
                   np.frombuffer(tokens, np.int32), words.split(b" ") if words else [])

    def with_ends(self, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Class of every token, each document followed by its end; lengths with the end."""
        sizes = self.sizes.astype(np.int64) + 1
        out = np.full(int(sizes.sum()), end, dtype=np.int32)
        is_word = np.ones(len(out), dtype=bool)
        is_word[np.cumsum(sizes) - 1] = False
        out[is_word] = classes[self.tokens] if len(self.tokens) else []
        return out, sizes


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        columns = [batch.column(n) for n in ("training", "sizes", "tokens", "words")]
        for row in range(batch.num_rows):
            yield Block.of(*[c[row].as_py() for c in columns])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks_of(batches):
        learn = np.repeat(block.training, block.sizes)
        counts = np.bincount(block.tokens[learn], minlength=len(block.words))
        seen = np.flatnonzero(counts).tolist()
        words = [block.words[i].decode() for i in seen]
        ends = int(block.training.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words + [END] * bool(ends), pa.string()),
             pa.array(counts[seen].tolist() + [ends] * bool(ends), pa.int64())], ["word", "n"])


def word_counts(blocks: DataFrame) -> DataFrame:
    """Stored (word, c): occurrences in all training texts, the end included."""
    found = blocks.select("training", "sizes", "tokens", "words").mapInArrow(
        _count_batches, "word string, n long")
    return store(found.groupBy("word").agg(F.sum("n").alias("c")), "counts")


class Classes:
    """The class of a word."""

    def __init__(self, common: list[str]) -> None:
        self.rank = {w.encode(): k for k, w in enumerate(common)}
        self.size = len(common) + ENDINGS + 1
        self.end = self.size - 1

    def of(self, words: list[bytes]) -> np.ndarray:
        first, rank, crc = len(self.rank), self.rank.get, zlib.crc32
        return np.array([
            k if (k := rank(w)) is not None else first + crc(w[-3:]) % ENDINGS for w in words
        ], dtype=np.int32)


@dataclass
class Model:
    """Start, transition (from, to) and emission (class, state) probabilities."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    @classmethod
    def scattered(cls, share: np.ndarray, states: int) -> Model:
        """A fixed uneven start around the class shares, states tending to stay."""
        rng = np.random.default_rng(11)
        emits = share[:, None] * rng.gamma(4.0, 0.25, (len(share), states))
        moves = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), moves, emits / emits.sum(0))

    @classmethod
    def of_counts(cls, counts: np.ndarray, share: np.ndarray, states: int) -> Model:
        """Maximisation: normalised expected counts with a little of the shares mixed in."""
        start, moves, emits = _parts(counts, states)
        start, moves = start + PRIOR, moves + PRIOR
        emits = emits + states * share[:, None]
        return cls(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def _parts(counts: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = states + states * states
    return (counts[:states], counts[states:at].reshape(states, states),
            counts[at:].reshape(-1, states))


def _order(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences by falling length, and how many of them are longer than each step."""
    order = np.argsort(-sizes, kind="stable")
    active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max()), side="right")
    return order, active


def log_likelihood(model: Model, seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence of classes, by the scaled forward recursion."""
    out = np.zeros(len(sizes))
    if not len(sizes):
        return out
    order, active = _order(sizes)
    at = (np.cumsum(sizes) - sizes)[order]
    total = np.zeros(len(sizes))
    alpha = model.start * model.emits[seen[at]]
    for t, n in enumerate(active.tolist()):
        if t:
            alpha = (alpha[:n] @ model.moves) * model.emits[seen[at[:n] + t]]
        scale = alpha.sum(1)
        total[:n] += np.log10(scale)
        alpha /= scale[:, None]
    out[order] = total
    return out


def expected_counts(model: Model, seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of start, moves and emissions over some sequences."""
    states = len(model.start)
    order, active = _order(sizes)
    at = (np.cumsum(sizes) - sizes)[order]
    active = active.tolist()
    alphas, scales, emitted = [], [], []
    alpha = None
    for t, n in enumerate(active):
        emitted.append(model.emits[seen[at[:n] + t]])
        before = np.broadcast_to(model.start, (n, states)) if t == 0 else alpha[:n] @ model.moves
        alpha = before * emitted[t]
        scale = alpha.sum(1, keepdims=True)
        alpha /= scale
        alphas.append(alpha)
        scales.append(scale)
    moves = np.zeros((states, states))
    beta = np.ones((active[-1], states))
    for t in range(len(active) - 1, -1, -1):
        if t < len(active) - 1:
            ahead = emitted[t + 1] * beta / scales[t + 1]
            n = active[t + 1]
            moves += alphas[t][:n].T @ ahead
            beta = np.ones((active[t], states))
            beta[:n] = ahead @ model.moves.T
        alphas[t] *= beta
    gamma = np.concatenate(alphas)
    classes = np.concatenate([seen[at[:n] + t] for t, n in enumerate(active)])
    emits = np.stack([np.bincount(classes, gamma[:, k], len(model.emits)) for k in range(states)], 1)
    return np.concatenate([alphas[0].sum(0), (moves * model.moves).ravel(), emits.ravel()])


def _stretches(seen: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All tokens as stretches of bounded length, in groups of bounded size."""
    pieces = -(-sizes // STRETCH)
    cut = np.full(int(pieces.sum()), STRETCH, dtype=np.int64)
    cut[np.cumsum(pieces) - 1] = sizes - (pieces - 1) * STRETCH
    ends = np.cumsum(cut)
    first = 0
    while first < len(cut):
        base = ends[first] - cut[first]
        last = max(first + 1, int(np.searchsorted(ends, base + _STRETCH_TOKENS, side="right")))
        yield seen[base:ends[last - 1]], cut[first:last]
        first = last


def counts_over(model: Model, seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    states = len(model.start)
    total = np.zeros(states + states * states + model.emits.size)
    for part, cut in _stretches(seen, sizes):
        total += expected_counts(model, part, cut)
    return total


def _training_part(block: Block, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    seen, sizes = block.with_ends(classes.of(block.words), classes.end)
    return seen[np.repeat(block.training, sizes)], sizes[block.training]


def pair_counts(blocks: DataFrame, classes: Classes) -> DataFrame:
    """Stored (a, b, n): how often class ``b`` follows ``a`` in all training texts.

    Before the first class of a text comes ``classes.size``.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = shared.value
        for block in _blocks_of(batches):
            seen, sizes = _training_part(block, kinds)
            before = np.empty_like(seen)
            before[1:] = seen[:-1]
            before[np.cumsum(sizes) - sizes] = kinds.size
            for at in range(0, len(seen), _STRETCH_TOKENS):
                part = slice(at, at + _STRETCH_TOKENS)
                codes, n = np.unique(
                    before[part].astype(np.int64) * kinds.size + seen[part], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((codes // kinds.size).astype(np.int32)),
                     pa.array((codes % kinds.size).astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["a", "b", "n"])

    found = blocks.select("training", "sizes", "tokens", "words").mapInArrow(run, "a int, b int, n long")
    return store(found.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")


def expected_pair_counts(model: Model, occupied: np.ndarray, a: np.ndarray, b: np.ndarray,
                         n: np.ndarray) -> np.ndarray:
    """Counts of start, moves and emissions over neighbouring classes, each pair seen by itself.

    ``occupied`` is the share of each state among those that another follows.
    """
    states, size = len(model.start), len(model.emits)
    first = a == size
    from_state = np.where(first[:, None], 0.0, occupied * model.emits[np.minimum(a, size - 1)])
    to_state = np.where(first[:, None], model.start, from_state @ model.moves) * model.emits[b]
    weight = n / to_state.sum(1)
    to_state *= weight[:, None]
    moves = (from_state * weight[:, None]).T @ model.emits[b] * model.moves
    emits = np.stack([np.bincount(b, to_state[:, k], size) for k in range(states)], 1)
    return np.concatenate([to_state[first].sum(0), moves.ravel(), emits.ravel()])


def _summed(found: DataFrame, cells: int) -> np.ndarray:
    """Counts (``cell``, ``x``) of many tasks added up."""
    sums = found.groupBy("cell").agg(F.sum("x").alias("x")).toArrow()
    counts = np.zeros(cells)
    counts[sums.column("cell").to_numpy()] = sums.column("x").to_numpy()
    return counts


def _start(blocks: DataFrame, classes: Classes, share: np.ndarray, states: int) -> Model:
    """Rounds over the pairs of neighbours in all training texts, so that full rounds begin
    with distinct states."""
    pairs = pair_counts(blocks, classes)
    model, occupied = Model.scattered(share, states), np.full(states, 1 / states)
    cells = states + states * states + model.emits.size
    for _ in range(START_ROUNDS):
        shared = blocks.sparkSession.sparkContext.broadcast((model, occupied))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, at = shared.value
            total = np.zeros(cells)
            for batch in batches:
                total += expected_pair_counts(now, at, *[batch.column(c).to_numpy() for c in ("a", "b", "n")])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], ["cell", "x"])

        counts = _summed(pairs.mapInArrow(run, "cell long, x double"), cells)
        if not counts.any():
            break
        model = Model.of_counts(counts, share, states)
        occupied = _parts(counts, states)[1].sum(1) + PRIOR
        occupied /= occupied.sum()
    drop_stored(pairs)
    return model


def baum_welch(blocks: DataFrame, model: Model, classes: Classes, share: np.ndarray) -> Model:
    """One round over all training texts: counts per task, added up across partitions."""
    shared = blocks.sparkSession.sparkContext.broadcast((model, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kinds = shared.value
        total = None
        for block in _blocks_of(batches):
            seen, sizes = _training_part(block, kinds)
            found = counts_over(now, seen, sizes)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], ["cell", "x"])

    states = len(model.start)
    found = blocks.select("training", "sizes", "tokens", "words").mapInArrow(run, "cell long, x double")
    counts = _summed(found, states + states * states + model.emits.size)
    return Model.of_counts(counts, share, states)


def _class_totals(counts: DataFrame, classes: Classes) -> np.ndarray:
    """Per class the sum of c + 0.1 over its words, and 0.1 for words not seen."""
    shared = counts.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(shared.value.size)
        for batch in batches:
            kinds = shared.value.of(as_bytes(batch.column("word")))
            totals += np.bincount(kinds, batch.column("c").to_numpy() + PRIOR, len(totals))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(totals))), pa.array(totals)], ["kind", "x"])

    rows = (
        counts.filter(F.col("word") != END).mapInArrow(run, "kind long, x double")
        .groupBy("kind").agg(F.sum("x").alias("x"))
    ).toArrow()
    totals = np.full(classes.size, PRIOR)
    totals[rows.column("kind").to_numpy()] += rows.column("x").to_numpy()
    return totals


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, joined in zip(batch.column("block").to_pylist(),
                                  batch.column("words").to_pylist()):
            words = joined.split(b" ") if joined else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), number)), pa.array(np.arange(len(words), dtype=np.int32)),
                 pa.array([w.decode() for w in words], pa.string())], ["block", "place", "word"])


def language_scores(docs: DataFrame, hold_out: int = HOLD_OUT, states: int = STATES,
                    rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.

    Null and empty texts are the end alone.  Repeated rows are scored each and
    learned from each; a null ``doc_id`` is held out; only ``doc_id`` and
    ``text`` are read.  Without any training text all counts are zero and the
    scores come from the priors.
    """
    blocks = token_blocks(docs, hold_out)
    counts = word_counts(blocks)
    whole = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
        F.coalesce(F.max(F.when(F.col("word") == END, F.col("c"))), F.lit(0)).alias("ends"),
    ).first()
    common = counts.filter(F.col("word") != END).orderBy(F.desc("c"), "word").limit(COMMON_WORDS)
    classes = Classes([r.word for r in common.collect()])
    totals = _class_totals(counts, classes)
    share = totals.copy()
    share[classes.end] = whole.ends + PRIOR
    share /= share.sum()
    model = _start(blocks, classes, share, states)
    for _ in range(rounds):
        model = baum_welch(blocks, model, classes, share)

    base = np.log10(whole.n + PRIOR * (whole.v + 1))
    shared = docs.sparkSession.sparkContext.broadcast((model, classes, np.log10(totals)))
    train_tokens, ends = int(whole.n), int(whole.ends)

    def run(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        now, kinds, log_totals = shared.value
        out = []
        for row in rows.itertuples():
            block = Block.of(row.training, row.sizes, row.tokens, row.words)
            c = np.zeros(len(block.words), dtype=np.int64)
            c[known["place"].to_numpy()] = known["c"].to_numpy()
            of = kinds.of(block.words)
            plain = np.log10(c + PRIOR)
            seen, sizes = block.with_ends(of, kinds.end)
            owner = np.repeat(np.arange(len(block.sizes)), block.sizes)

            def per_doc(values: np.ndarray) -> np.ndarray:
                return np.bincount(owner, values[block.tokens], len(block.sizes))

            out.append(pd.DataFrame({
                "doc_id": pd.array(row.doc_ids, dtype=object),
                "held_out": ~block.training,
                "n_tokens": sizes,
                "n_known": per_doc((c > 0).astype(float)).astype(np.int64) + (ends > 0),
                "train_tokens": train_tokens,
                "base_score": per_doc(plain) + np.log10(ends + PRIOR) - sizes * base,
                "score": log_likelihood(now, seen, sizes) + per_doc(plain - log_totals[of]),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[
            "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    known = (
        blocks.select("block", "words").mapInArrow(_word_rows, "block long, place int, word string")
        .join(counts, "word").select("block", "place", "c")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
