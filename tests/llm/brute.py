"""Plain single-machine versions of the text operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def rows_of(docs):
    """Distinct-id documents as (id, text) in id order; null text empty."""
    return sorted((d, t or "") for d, t in docs)


def removed(docs, window=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) by comparing every window."""
    first, gone = {}, {}
    for doc, text in rows_of(docs):
        data = text.encode()
        mask = bytearray(len(data))
        for at in range(len(data) - window + 1):
            if first.setdefault(data[at:at + window], (doc, at)) != (doc, at):
                mask[at:at + window] = b"\1" * window
        gone[doc] = (data, mask)
    out = {}
    for doc, (data, mask) in gone.items():
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        kept = bytes(b for b, m in zip(data, mask) if not m)
        out[doc] = (len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


def ascii_words(text):
    return text.encode().lower().split()


def line_words(line):
    return line.lower().encode().split()


def simhash(text, width=4):
    words = ascii_words(text)
    parts = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def linked(ids, near):
    """id -> least id reachable over pairs for which ``near`` holds."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def held_out(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus == 0


def base_scores(docs):
    """doc_id -> (n_tokens, n_known, N, base score)."""
    counts = Counter()
    for doc, text in docs:
        if not held_out(doc, 10):
            counts.update(ascii_words(text or ""))
            counts[" "] += 1
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for doc, text in docs:
        tokens = [*ascii_words(text or ""), " "]
        score = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[doc] = (len(tokens), sum(counts[t] > 0 for t in tokens), total, score)
    return out


def top_products(vectors, k=5, every=50):
    whole = {}
    for vec, x in vectors:
        if vec is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        ints = [math.floor(256 * v) for v in x]
        whole[vec] = min(whole.get(vec, ints), ints)
    out = []
    for q, a in whole.items():
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in whole.items()
                        if v != q and len(b) == len(a))[:k]
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scored)]
    return sorted(out)


def kept_lines(docs, threshold=0.8):
    """doc_id -> removed line numbers: lines whose word set is near an earlier one."""
    seen, by_word, out = [], defaultdict(set), {}
    for doc, text in rows_of(docs):
        gone = []
        for number, line in enumerate(text.split("\n")):
            words = frozenset(line_words(line))
            if not words:
                continue
            rivals = set().union(*[by_word[w] for w in words])
            if any(len(words & seen[r]) >= threshold * len(words | seen[r]) - 1e-9 for r in rivals):
                gone.append(number)
            for w in words:
                by_word[w].add(len(seen))
            seen.append(words)
        out[doc] = gone
    return out


def ngram_words(text):
    return [w for w in re.split(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower()) if w]


def ngrams(text, width=3):
    words = ngram_words(text)
    return [b" ".join(words[i:i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def resampled(docs, target, share=5, least=20, seed=42, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) of every row."""
    s, t = ([0] * buckets for _ in range(2))
    for counts, rows in ((s, [text for _, text in docs]), (t, target)):
        for text in rows:
            for gram in ngrams(text):
                counts[zlib.crc32(gram) % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
            for a, b in zip(s, t)]
    out = []
    for doc, text in docs:
        grams = ngrams(text)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in grams)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(grams), weight, score, len(ngram_words(text))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [r[:4] for r in able[:share * len(able) // 100]]
    rank = {r[0]: k for k, r in enumerate(drawn, 1)}
    return [(*r[:4], rank.get(r[0]) if r[4] >= least else None) for r in out]


def hard_negatives(vectors, relabel=None, every=100, n_positives=5, n_negatives=10, band=(30, 90)):
    """Rows of (anchor, positive, rank, negative, positive score, negative score)."""
    whole = {}
    for vec, x, label in vectors:
        if None in (vec, x, label) or any(v is None or not math.isfinite(v) for v in x):
            continue
        row = ([math.floor(256 * v) for v in x], relabel(vec, label) if relabel else label)
        whole[vec] = min(whole.get(vec, row), row)
    out = []
    for a, (ints, label) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(ints, v)), b, lab) for b, (v, lab) in whole.items()
                        if b != a and len(v) == len(ints))
        for ps, p, _ in [r for r in scored if r[2] == label][:n_positives]:
            near = [(s, b) for s, b, lab in scored if lab != label
                    and band[0] * -ps <= 100 * -s <= band[1] * -ps][:n_negatives]
            out += [(a, p, k, b, -ps, -s) for k, (s, b) in enumerate(near, 1)]
    return sorted(out)
