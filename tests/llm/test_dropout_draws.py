"""Merge-dropout draws for every occurrence of a word."""

import numpy as np

from eventloom.llm import dropout


def test_every_occurrence_draws_anew():
    codec = dropout.DropoutCodec(rate=0.3)
    whole = codec.encode(" ".join(["internationalization"] * 400), 5)
    blank = codec.surface
    words, word = [], []
    for i in whole.tolist():
        if word and blank[i].startswith(b" "):
            words.append(tuple(word))
            word = []
        word.append(i)
    words.append(tuple(word))
    assert len(words) == 400 and len(set(words)) > 4
    assert whole.tolist() != codec.encode(" ".join(["internationalization"] * 400), 6).tolist()


def test_remembered_runs_equal_a_direct_walk(monkeypatch):
    text = "abc the theorem internationalization of antidisestablishmentarianism-pseudopseudohypoparathyroidism ▁ é" * 5
    codec = dropout.DropoutCodec(rate=0.3)
    short = [codec.encode(text, d).tolist() for d in range(20)]
    monkeypatch.setattr(dropout, "_LONG", 1)
    assert short == [codec.encode(text, d).tolist() for d in range(20)]
    assert all(codec.decode(np.array(s, "<u4")) == text for s in short)


def test_share_of_skipped_turns_is_the_rate():
    codec = dropout.DropoutCodec(rate=0.1)
    drawn = codec._draws(codec._starts(1, 20_000), 0, 16)
    assert abs(drawn.mean() - 0.1) < 0.005 and abs(drawn.mean(0) - 0.1).max() < 0.02


def test_query_returns_the_ids(docs):
    rows = dropout.round_trip(docs).collect()
    assert all(len(r.ids) == r.n_tokens and r.lossless for r in rows)
