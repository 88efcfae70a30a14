"""SpotSigs columns, merge-dropout, best-fit choice and neighbour votes against plain versions."""

import hashlib
import math

import numpy as np
import pytest
import xxhash

from eventloom.llm import dropout, packing, quality, spotsigs

MARK = "\x01"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained_hash(parts, seed=42):
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed


def plain_signatures(text, chain=spotsigs.CHAIN):
    table = str.maketrans({c: " " for c in "\x01\t\n\x0b\f\r"})
    words = [w for w in text.lower().translate(table).split(" ") if w]
    # Anchors between two content words hang together on the one before.
    hung = [["", []]]
    for word in words:
        if word in spotsigs.ANCHORS:
            hung[-1][1].append(word)
        else:
            hung.append([word, []])
    found = set()
    for k, (_, anchors) in enumerate(hung):
        following = [w for w, _ in hung[k + 1:k + 1 + chain]]
        if anchors and following:
            parts = [MARK.join(anchors), *following]
            found.add(signed(chained_hash(p.encode() for p in parts)))
    if not found and words:
        found.add(signed(chained_hash([" ".join(words).encode()])))
    return sorted(found)


def plain_label(signs):
    def packed(first):
        return f"{chained_hash([*first, *[s.to_bytes(8, 'little', signed=True) for s in signs]]):016x}"

    return f"{len(signs)}:{packed([])}{packed([(1).to_bytes(4, 'little')])}"


def plain_likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def test_every_column_of_the_fingerprint_report(docs, rows):
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    want = {}
    for k, (doc, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = map(plain_signatures, (text, edited, following))
        want[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_label(own), plain_label(other),
                     plain_likeness(own, other), plain_likeness(own, after))
    got = {r.doc_id: tuple(r)[1:] for r in spotsigs.fingerprint_report(docs).collect()}
    assert got.keys() == want.keys()
    for doc in want:
        assert got[doc][:4] == want[doc][:4], doc
        assert got[doc][4:] == pytest.approx(want[doc][4:])


@pytest.mark.parametrize("text", [
    "", " ", "the", "the of", "x", "the x", "x the of y z", "The\tOF x\x0by", "a\x01b the c", "x the", "été la vie est"])
def test_signatures_of_small_texts(spark, text):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(text,)], "text string").select(spotsigs.signatures(F.col("text")).alias("s")).first()
    assert row.s == plain_signatures(text)


def plain_dropout(codec, run, skipped):
    """Merge the best-ranked neighbours, leftmost first, unless their turn is skipped."""
    parts, banned, turn = list(run.replace("▁", "\ud800").replace(" ", "▁")), set(), -1
    marks = list(range(len(parts)))
    while True:
        best = None
        for k in range(len(parts) - 1):
            rank = codec.ranks.get(parts[k] + parts[k + 1])
            if rank is not None and (marks[k], marks[k + 1], parts[k], parts[k + 1]) not in banned:
                if best is None or rank < best[0]:
                    best = (rank, k)
        if best is None:
            return codec._spell(parts)
        turn, k = turn + 1, best[1]
        if skipped(turn):
            banned.add((marks[k], marks[k + 1], parts[k], parts[k + 1]))
            continue
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
        del marks[k + 1]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_merge_dropout_equals_a_plain_agenda(rate):
    codec = dropout.DropoutCodec(rate=rate)
    text = "the internationalization of words, ▁ é 日本 aaaaaaaa  two  blanks thethethethe-therefore"
    for doc in range(6):
        runs = dropout._RUNS.findall(" " + text)
        starts = codec._starts(doc, len(runs))
        want = []
        for run, start in zip(runs, starts):
            drawn = codec._draws(np.array([start], dtype="<u8"), 0, 256)[0]
            want += plain_dropout(codec, run, lambda turn: drawn[turn])
        assert codec.encode(text, doc).tolist() == want
        assert codec.decode(np.array(want, "<u4")) == text


def plain_best_fit(lengths, capacity):
    """Largest first; every open bin is tried, the least cost wins, ties go to the oldest."""
    limits, bins, where = capacity.limits, [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        demand = (lengths[i], 1, lengths[i] ** 2)
        best = None
        for b, left in enumerate(bins):
            rest = [x - y for x, y in zip(left, demand)]
            if min(rest) < 0 or min(left) < 1:
                continue
            if capacity.rule == "norm":
                cost = sum(w * (r / m) ** 2 for w, r, m in zip(capacity.weights, rest, limits))
            else:
                cost = -sum(w * (x / m) * (d / m) for w, x, d, m in zip(capacity.weights, left, demand, limits))
            if best is None or cost < best[0] - 1e-15:
                best = (cost, b)
        if best is None:
            bins.append(list(map(float, limits)))
            best = (0, len(bins) - 1)
        where[i] = (best[1], int(capacity.tokens - bins[best[1]][0]))
        bins[best[1]] = [x - y for x, y in zip(bins[best[1]], demand)]
    return where


@pytest.mark.parametrize("capacity", [
    packing.Capacity(), packing.Capacity(100, 7, 6000, (1.0, 0.5, 0.5)), packing.Capacity(100, 7, 6000, (1.0, 0.5, 0.5), "dot")])
def test_best_fit_chooses_as_a_plain_search(capacity):
    rng = np.random.default_rng(4)
    for _ in range(5):
        lengths = rng.integers(1, min(capacity.tokens, 77) + 1, 150)
        bins, offsets = packing.best_fit(lengths, capacity)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_best_fit(lengths.tolist(), capacity)


def test_votes_equal_a_plain_count():
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["ab", "cde", "fgh", "ij", "klm", "nop"], rng.integers(1, 40))).encode() for _ in range(120)]
    rows = np.stack([quality.term_vector(t) for t in texts])
    labels = rng.integers(0, 2, 80)
    model = quality.fit_latent(rows[:80], labels, dimensions=8, neighbours=9)
    embedded = model.embed(rows)
    got = model.score(rows[80:])
    for k, score in enumerate(got):
        cosines = [float(np.dot(embedded[80 + k].astype(np.float64), v.astype(np.float64))) for v in embedded[:80]]
        near = sorted(range(80), key=lambda i: -cosines[i])[:9]
        weight = [max(0.0, cosines[i]) ** 4 for i in near]
        want = sum(w * labels[i] for w, i in zip(weight, near)) / sum(weight)
        assert math.isclose(score, want, rel_tol=1e-4, abs_tol=1e-4)
