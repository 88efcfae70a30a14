"""The pipeline's near-copy stage against brute force."""

import os
import random
import sys

import brute
import corpus_pipeline
import numpy as np
import pytest

from eventloom.llm import nearcopies, simhash
from eventloom.llm.components import components


def shingles(text, width=5):
    words = brute.ascii_words(text)
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b) - 1e-9


@pytest.fixture(scope="module")
def edited():
    """Texts and copies with a few words changed, at similarities on both sides of 0.8."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    out = []
    for _ in range(30):
        words = [word() for _ in range(200)]
        out.append(" ".join(words))
        for changes in (1, 3, 4, 6):
            other = list(words)
            for at in rng.sample(range(200), changes):
                other[at] = "edited" + word()
            out.append(" ".join(other))
    notice = " ".join(word() for _ in range(60))
    out += [f"{notice} {' '.join(word() for _ in range(n))}" for n in (5, 8, 30, 70, 90) * 6]
    return list(enumerate(out + ["", None, " ", "one two", "ONE two", out[0]]))


def test_stage_keeps_one_of_each_group_at_similarity_08(spark, edited, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    docs = spark.createDataFrame(edited, "doc_id long, text string").repartition(3)
    sets = {d: shingles(t or "") for d, t in edited}
    roots = brute.linked(list(sets), lambda a, b: alike(sets[a], sets[b]))
    kept = corpus_pipeline.simhash_stage(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def test_odd_rows(docs, rows, odd, none):
    sets = {d: shingles(t or "") for d, t in rows}
    roots = brute.linked(list(sets), lambda a, b: alike(sets[a], sets[b]))
    assert sorted(r.doc_id for r in nearcopies.keep_first(docs).collect()) == sorted(set(roots.values()))
    out = nearcopies.keep_first(odd)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == odd.columns and ids.count(None) == 2 and ids.count(0) == 1
    assert nearcopies.keep_first(none).count() == 0


def test_stage_drops_copies_that_the_line_stage_leaves(spark):
    words = [f"w{k}" for k in range(120)]
    broken = ["\n".join(" ".join(words[i:i + n]) for i in range(0, 120, n)) for n in (12, 40)]
    rows = [*enumerate(broken), (2, "another text of its own")]
    docs = corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id: r.text for r in docs.collect()} == dict(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_stage(spark, docs, "").collect()) == [0, 2]


def test_slices_give_the_same_groups_and_leave_no_tables(spark, edited, monkeypatch):
    monkeypatch.setattr(nearcopies, "_PART_BYTES", 1 << 17)
    docs = spark.createDataFrame(edited, "doc_id long, text string").repartition(3)
    written, store = [], nearcopies.store

    def seen(df, label):
        out = store(df, label)
        written.append((label, out.stored_path))
        return out

    monkeypatch.setattr(nearcopies, "store", seen)
    sets = {d: shingles(t or "") for d, t in edited}
    roots = brute.linked(list(sets), lambda a, b: alike(sets[a], sets[b]))
    kept = nearcopies.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
    labels = [label for label, _ in written]
    assert labels.count("further") > 1 and labels.count("counted") > 2
    # What grows with shingles or pairs goes as soon as it has been used.
    left = {label for label, path in written if os.path.exists(path.removeprefix("file:"))}
    assert left <= {"lows", "verified"}


def test_sketches_never_rule_out_a_pair_of_the_threshold():
    rng = np.random.default_rng(6)
    for n in (1, 3, 40, 333, 2000):
        for share in (0.0, 0.3, 0.7, 0.95, 1.0):
            common = int(n * share)
            keys = rng.integers(-2**63, 2**63 - 1, 2 * n + 3 - common)
            x, y = keys[:n], np.concatenate([keys[:common], keys[n:n + n - common + 3]])
            differ = len(set(x) ^ set(y))
            apart = nearcopies.parity_apart(nearcopies.parity(x), nearcopies.parity(y))
            assert apart <= differ and apart % 2 == differ % 2
    x, y = rng.integers(-2**63, 2**63 - 1, (2, 900))
    assert nearcopies.parity_apart(nearcopies.parity(x), nearcopies.parity(y)) > 400


def test_only_likely_pairs_have_their_sets_compared(spark, monkeypatch):
    rng = random.Random(9)
    passage = [f"p{rng.randrange(500)}" for _ in range(150)]
    # One long passage in texts that are otherwise apart: prefixes meet, similarities stay near 0.6.
    rows = [(k, " ".join([f"w{rng.randrange(10**6)}" for _ in range(50)] + passage)) for k in range(20)]
    sizes, verified = [], nearcopies._verified

    def seen(pairs, *others):
        sizes.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(nearcopies, "_verified", seen)
    # No shingle counts as common, so that rare and common ones are mixed.
    monkeypatch.setattr(nearcopies, "_magnitudes", lambda docs, width: np.zeros(nearcopies._CELLS, np.uint8))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert nearcopies.keep_first(docs).count() == 20
    assert sizes[-1] < 10  # all 190 pairs meet


def test_shingles_of_every_text_are_counted(spark):
    words = [[f"w{k}_{j}" for j in range(5)] for k in range(64)]
    rows = [(k, " ".join(w)) for k, w in enumerate(words)] + [(64 + k, " ".join(words[0])) for k in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = np.zeros(nearcopies._CELLS, int)
    for _, text in rows:
        np.add.at(counts, nearcopies.shingle_hashes(text.encode()).view(np.int64) & (nearcopies._CELLS - 1), 1)
    sizes = nearcopies._magnitudes(docs, 5)
    assert sizes.tolist() == (4 * np.log2(counts + 1)).astype(np.uint8).tolist()
    assert not nearcopies._magnitudes(docs.limit(0), 5).any()


def test_no_join_of_the_stage_is_broadcast(spark, docs, monkeypatch):
    plans = []
    for module in (nearcopies, sys.modules[components.__module__]):
        def seen(df, label, store=module.store):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return store(df, label)

        monkeypatch.setattr(module, "store", seen)
    last = nearcopies.keep_first(docs)
    plans.append(last._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) > 5
    assert not [plan for plan in plans if "Broadcast" in plan]
