"""Encoder, packer, search, classifier, language model and license scan."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventloom.llm import dropout, hmm, licenses, packing, quality, topk


def test_without_dropout_pieces_are_the_library_s(rows):
    codec = dropout.DropoutCodec(rate=0.0)
    library = sentencepiece.SentencePieceProcessor(model_file=dropout.MODEL)
    for _, text in rows:
        if text and "▁" not in text:
            assert codec.encode(text).tolist() == library.encode(text)


def test_dropout_is_lossless_repeatable_and_varied(docs, rows, odd, none):
    coded = dropout.encode(docs, rate=0.3)
    back = {r.doc_id: r.text for r in dropout.decode(coded).collect()}
    assert back == {d: t or "" for d, t in rows}
    ids = {r.doc_id: r.ids for r in coded.collect()}
    assert ids == {r.doc_id: r.ids for r in dropout.encode(docs, rate=0.3).collect()}
    other = {r.doc_id: r.ids for r in dropout.encode(docs, seed=9, rate=0.3).collect()}
    assert sum(ids[d] != other[d] for d in ids) > len(ids) / 2
    assert all(r.lossless for r in dropout.round_trip(odd).collect())
    assert dropout.round_trip(none).count() == 0 and dropout.encode(none).count() == 0


def test_short_and_long_agendas_agree(monkeypatch):
    texts = ["abc the theorem", "internationalization", "x" * 150]
    short = [dropout.DropoutCodec(rate=0.0).encode(t).tolist() for t in texts]
    monkeypatch.setattr(dropout, "_LONG", 1)
    assert short == [dropout.DropoutCodec(rate=0.0).encode(t).tolist() for t in texts]


def test_runs_are_encoded_as_the_whole_text(rows):
    encoder = packing.ChunkEncoder(packing.TOKENIZER)
    library = Tokenizer.from_file(packing.TOKENIZER)
    odd = ["<|endoftext|> x", "It's I'LL 'S ñ'sÉ", "ΑΣ Σ", "İx", "a\x1cb c", "ﬁ Å Å", "x² ½ª\n\n x", "don't!?...ß"]
    for text in [t or "" for _, t in rows] + odd:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_packing_is_whole_and_tight(docs, rows, odd, none):
    library = Tokenizer.from_file(packing.TOKENIZER)
    out = packing.packed_sequences(docs, packing.Capacity(tokens=256)).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for d, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[d], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), 256))
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in out)
    assert len(bins) <= -(-total // 256) + 2
    assert packing.packed_sequences(odd).count() == odd.count()
    assert packing.packed_sequences(none).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 400)
    capacity = packing.Capacity(tokens=100, documents=3, attention=5000 if rule == "dot" else 10_000,
                                rule=rule)
    lengths = lengths[lengths**2 <= capacity.attention]
    bins, offsets = packing.best_fit(lengths, capacity)
    for b in np.unique(bins):
        inside = lengths[bins == b]
        assert inside.sum() <= 100 and len(inside) <= 3 and (inside**2).sum() <= capacity.attention
        assert sorted(offsets[bins == b])[0] == 0
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), packing.Capacity(tokens=100))


def _vectors():
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(300)]
    rows += [(k, [0.5] * 8) for k in range(300, 360)] + [(400, [1.0, 2.0]), (450, [2.0, 1.0])]
    rows += [(500, None), (501, [None] * 8), (502, [float("nan")] * 8), (503, [float("inf")] * 8),
             (None, [0.1] * 8), (50, [0.1] * 8), (600, []), (650, [])]
    return rows


def test_search_is_exact(spark, monkeypatch):
    frame = spark.createDataFrame(_vectors(), "vec_id long, embedding array<float>")
    frame = frame.selectExpr("*", "1 AS shard", "2 AS ints", "3 AS floor")
    want = brute.top_products([(r.vec_id, r.embedding) for r in frame.collect()])
    for rows in (4096, 40):
        got = topk.top_products(frame, shard_rows=rows)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert topk.top_products(frame.limit(0)).count() == 0


def test_wide_integers_stay_exact():
    points = np.array([[2**40, 1], [2**40, 2], [2**40, 3]], dtype=np.int64)
    tree = topk.BallTree(np.array([1, 2, 3]), points)
    best = tree.search(9, np.array([2**20, 1]), 2, topk._NO_FLOOR)
    assert best == [(2**60 + 3, 3), (2**60 + 2, 2)]


def test_labelled_rows_reach_the_driver_small_and_unchanged(spark, docs, rows, monkeypatch):
    labels = spark.createDataFrame([(d, d % 2) for d, _ in rows], "doc_id long, quality int")
    sent, fitted, pack, fit = [], [], quality._packed_batches, quality.fit_latent
    monkeypatch.setattr(quality, "fit_latent", lambda terms, marks: fitted.append((terms, marks)) or fit(terms, marks))
    quality.learn(docs, labels)
    used = [(quality.term_vector((t or "").encode()).tobytes(), d % 2) for d, t in rows
            if zlib.crc32(str(d).encode()) % quality.HOLD_OUT]
    terms, marks = fitted[0]
    assert [(t.tobytes(), int(q)) for t, q in zip(terms, marks)] == sorted(used)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in used], pa.binary()), pa.array([q for _, q in used], pa.int32())], ["terms", "quality"])
    for out in pack(iter([batch])):
        sent += out.column("terms").to_pylist()
    assert 4 * sum(map(len, sent)) < sum(len(t) for t, _ in used)


def test_classifier_learns_and_handles_odd_rows(spark, docs, odd, none):
    good = [(2 * k, f"plain sentences about {k} things and their names, told calmly.", 1) for k in range(80)]
    bad = [(2 * k + 1, "BUY!! NOW!! FREE!! " * (3 + k % 5), 0) for k in range(80)]
    frame = spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in good + bad] + [(None, 1), (0, None)],
                                   "doc_id long, quality int")
    model = quality.learn(frame, labels)
    truth = {r[0]: r[2] for r in good + bad}
    out = quality.quality_scores(frame, model).collect()
    assert {r.held_out for r in out} == {True, False}
    assert all(r.held_out == brute.held_out(r.doc_id, 5) for r in out)
    assert all(r.predicted == truth[r.doc_id] for r in out if r.held_out)
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(odd, model).collect())
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.keep_good(frame, model).count() == 80
    assert quality.quality_scores(none, model).count() == 0
    unlabelled = quality.learn(frame, labels.limit(0))
    assert {r.score for r in quality.quality_scores(docs, unlabelled).collect()} == {0.5}


def test_language_scores(docs, rows, odd, none):
    want = brute.base_scores(rows)
    out = hmm.language_scores(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert r.held_out == brute.held_out(r.doc_id, 10)
    assert hmm.language_scores(odd).count() == odd.count()
    assert hmm.language_scores(none).count() == 0


def test_forward_recursion_is_the_sum_over_paths():
    import itertools

    rng = np.random.default_rng(6)
    model = hmm.Model(*[x / x.sum(axis, keepdims=True) for x, axis in (
        (rng.random(3), 0), (rng.random((3, 3)), 1), (rng.random((5, 3)), 0))])
    seqs = [rng.integers(0, 5, n) for n in (1, 4, 6, 2)]
    got = hmm.log_likelihood(model, np.concatenate(seqs), np.array([len(s) for s in seqs]))
    for seq, value in zip(seqs, got):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emits[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.moves[path[t - 1], path[t]] * model.emits[seq[t], path[t]]
            total += p
        assert value == pytest.approx(np.log10(total))


def test_baum_welch_rounds_raise_the_likelihood():
    rng = np.random.default_rng(7)
    seen = np.concatenate([np.repeat(rng.integers(0, 2) * 3, 40) + rng.integers(0, 3, 40) for _ in range(60)])
    sizes = np.full(60, 40, dtype=np.int64)
    share = np.bincount(seen, minlength=6) / len(seen)
    model, last = hmm.Model.scattered(share, 2), -np.inf
    for _ in range(8):
        now = hmm.log_likelihood(model, seen, sizes).sum()
        assert now > last - 1e-3
        last = now
        model = hmm.Model.of_counts(hmm.counts_over(model, seen, sizes), share, 2)


def _licensed(rows):
    """(doc_id, license) by comparing every window of every template's class."""
    import re

    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    found = set()
    for _, (name, notice) in enumerate(licenses.TEMPLATES):
        own = words(notice)
        width = min(5, len(own))
        need = {" ".join(own[i:i + width]) for i in range(len(own) - width + 1)}
        size = 1 << (len(need) - 1).bit_length()
        for doc, text in rows:
            parts = words(text)
            all_of = [" ".join(parts[i:i + width]) for i in range(len(parts) - width + 1)]
            for at in range(0, len(all_of), size):
                if len(need & set(all_of[at:at + 2 * size])) >= 0.8 * len(need):
                    found.add((doc, name))
    return found


def test_licenses_match_brute_force(spark, docs, rows, odd, none):
    shelf = licenses.template_table(spark)
    got = {(r.doc_id, r.license_id) for r in licenses.scan_licenses(docs, shelf).collect()}
    want = _licensed(rows)
    assert len(want) >= 3 and got == want
    assert licenses.scan_licenses(odd, shelf).count() >= 0
    assert licenses.scan_licenses(none, shelf).count() == 0
    assert licenses.scan_licenses(docs, shelf.limit(0)).count() == 0


def test_token_blocks_take_less_disk_than_their_texts(spark):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 300, 400))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks = hmm.token_blocks(docs)
    stored = sum(r.length for r in spark.read.format("binaryFile").load(blocks.stored_path).select("length").collect())
    assert stored < 0.5 * sum(len(text) for _, text in rows)
    assert sum(len(r.tokens) // 4 for r in blocks.collect()) == 400 * 400


def test_runs_with_an_end_mark_and_one_encoder_per_worker():
    assert packing._encoder(packing.TOKENIZER) is packing._encoder(packing.TOKENIZER)
    encoder = packing.ChunkEncoder(packing.TOKENIZER)
    runs = ["word,", "Word.", "WÖRTER!", "émile?", "a.b.", "x1,", "it's;", ",", ".,", "don't,", "ßé:", "日本,", "i̇.",
            "ª.", "x‍,", "Ⱥ,", "<|x,", "ab&&&", ""]
    for run in [*runs, " ".join(runs)]:
        want = encoder.full.encode(run, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(run), "<u4").tolist() == want, run
