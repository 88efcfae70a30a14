"""SimHash components, line dedup, passages and fingerprints against brute force."""

import hashlib
import sys

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import lines, passages, simhash, spotsigs
from eventloom.llm.components import components
from eventloom.llm.suffixes import permuted_common_prefixes, suffix_array


def test_masks_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(3)
    masks = simhash.covering_masks()
    assert len(masks) == 31
    for _ in range(3000):
        apart = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any(not apart & m for m in masks)


def test_simhash_components_match_brute_force(docs, rows):
    got = {r.doc_id: (r.mark & (2**64 - 1), r.component_id) for r in simhash.simhash_components(docs).collect()}
    marks = {d: brute.simhash(t or "") for d, t in rows}
    roots = brute.linked(list(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    assert got == {d: (marks[d], roots[d]) for d in marks}


def test_large_buckets_are_cut_and_still_whole(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**62, 3)
    marks = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(62, 3)) for c in centres for _ in range(40)})
    frame = spark.createDataFrame([(k, m) for k, m in enumerate(marks)], "node long, mark long")
    roots = {r.node: r.root for r in components(simhash.near_links(frame), "u", "v").collect()}
    want = brute.linked(range(len(marks)), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    assert {k: roots.get(k, k) for k in want} == want


def test_no_join_sends_rows_of_all_documents_to_the_driver(spark, docs, monkeypatch):
    # Spark takes the rows of 31 masks for those of one, so a table of any size could be broadcast.
    plans = []
    for module in (simhash, sys.modules[components.__module__]):
        def seen(df, label, store=module.store):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return store(df, label)

        monkeypatch.setattr(module, "store", seen)
    last = simhash.simhash_components(docs)
    plans.append(last._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) >= 2
    assert not [plan for plan in plans if "Broadcast" in plan]


def test_keep_first_leaves_one_of_each_group(docs, odd, none):
    found = simhash.simhash_components(docs)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r[0] for r in found.select("component_id").distinct().collect())
    out = simhash.keep_first(odd)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == odd.columns and ids.count(None) == 2 and ids.count(0) == 1
    assert simhash.keep_first(none).count() == 0
    assert simhash.simhash_components(none).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(21)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("symbols", [1, 2, 5, 2000])
def test_suffix_array_and_prefixes(symbols):
    rng = np.random.default_rng(symbols)
    for _ in range(60):
        text = rng.integers(0, symbols, int(rng.integers(0, 70)))
        order = suffix_array(text)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert order.tolist() == want
        shared = permuted_common_prefixes(text, order, 6)
        for a, b in zip(want[1:], want):
            n = 0
            while n < 6 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[a] == n


def test_common_prefixes_compare_many_symbols_at_once(monkeypatch):
    """Two long equal halves: about as many steps as words of symbols, not as symbols."""
    half = np.random.default_rng(4).integers(0, 256, 500).astype(np.uint16)
    text = np.concatenate([half, [256], half, [257]]).astype(np.uint16)
    order = suffix_array(text)
    steps = []

    class Places(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == bool:
                steps.append(1)
            return super().__getitem__(key)

    plain = np.flatnonzero
    monkeypatch.setattr(np, "flatnonzero", lambda a: plain(a).view(Places))
    shared = permuted_common_prefixes(text, order, 100)
    before = dict(zip(order[1:].tolist(), order[:-1].tolist()))
    for at, other in before.items():
        least = 0
        while least < 100 and max(at, other) + least < len(text) and text[at + least] == text[other + least]:
            least += 1
        assert shared[at] == least
    assert len(steps) <= 45


def test_passages_match_brute_force(docs, rows):
    got = {r[0]: tuple(r[1:]) for r in passages.removal_report(docs).collect()}
    assert got == brute.removed(rows)


def test_passages_by_hashes_of_windows_agree(docs, rows):
    report = passages.removal_report(docs, many_runs=1, stretch=700)
    got = {r[0]: tuple(r[1:]) for r in report.collect()}
    assert got == brute.removed(rows)


def test_passages_odd_rows(odd, none):
    out = passages.removal_report(odd).collect()
    assert len(out) == odd.count()
    # A repeated row is the same document and keeps its text; rows without an id too.
    assert {r.n_removed for r in out if r.doc_id in (0, None)} == {0}
    assert passages.removal_report(none).count() == 0
    cleaned = passages.without_repeats(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == odd.count()
    assert passages.without_repeats(none).count() == 0


def test_rest_of_passages_is_text(docs):
    out = {r.doc_id: r for r in passages.without_repeats(docs).collect()}
    report = {r.doc_id: r for r in passages.removal_report(docs).collect()}
    for r in docs.collect():
        if r.text is None:
            assert out[r.doc_id].text is None
        else:
            lost = len(r.text.encode()) - len(out[r.doc_id].text.encode())
            assert 0 <= report[r.doc_id].n_removed - lost <= 8 * report[r.doc_id].n_spans
            assert out[r.doc_id].n_chars == len(out[r.doc_id].text)


def test_lines_match_brute_force(docs, rows):
    got = {r.doc_id: r.removed_lines for r in lines.line_report(docs).collect()}
    assert got == brute.kept_lines(rows)


def test_pairs_verified_in_several_parts_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    whole = [sorted(rng.choice(24, 20, replace=False).tolist()) for _ in range(40)]
    # Sketches that say nothing, so that the nearest candidate is any and mostly fails.
    rows = [(k, (k, 0), keys, len(keys), 0, 0, 0) for k, keys in enumerate(whole)]
    sets = spark.createDataFrame(
        rows, "sig long, first struct<doc_id: long, line: int>, keys array<long>, n int, w0 long, w1 long, w2 long")
    pairs = spark.createDataFrame([(a, b) for b in range(40) for a in range(b)], "a long, b long")
    seen = []

    def three(rest, _):
        seen.append(rest.count())
        return [(part, 3) for part in range(3)]

    monkeypatch.setattr(lines, "_parts", three)
    got = [r.sig for r in lines._repeats(pairs, sets, 0.8).collect()]
    want = [b for b in range(40) if any(
        5 * len({*whole[a]} & {*whole[b]}) >= 4 * len({*whole[a]} | {*whole[b]}) for a in range(b))]
    assert sorted(got) == want
    assert seen[0] > 100 and 0 < len(want) < 39


def test_parts_follow_the_bytes_of_the_pairs(spark, monkeypatch):
    rest = spark.range(1000).selectExpr("id a", "id b", "10 n")
    sets = spark.range(50).selectExpr("id sig", "10 n")
    assert lines._parts(rest, sets) == [(0, 1)]
    monkeypatch.setattr(lines, "_PART_BYTES", 1)
    assert lines._parts(rest, sets) == [(part, 10) for part in range(10)]
    assert lines._parts(rest.limit(0), sets) == []


def test_lines_taken_out_of_texts(docs, rows, odd, none):
    gone = brute.kept_lines(rows)
    out = {r.doc_id: r for r in lines.without_repeated_lines(docs).collect()}
    for d, text in rows:
        if text is None:
            assert out[d].text is None
            continue
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[d])
        assert (out[d].text, out[d].n_chars) == (kept, len(kept))
    cleaned = lines.without_repeated_lines(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == odd.count()
    assert lines.line_report(odd).count() == odd.select("doc_id").distinct().count() - 1
    assert lines.line_report(none).count() == 0
    assert lines.without_repeated_lines(none).count() == 0


def test_fingerprints_and_edited_texts(docs, rows):
    got = {r.doc_id: r for r in spotsigs.fingerprint_report(docs).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    for k, (d, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].n_chars == len(text)
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        if got[d].fingerprint == got[d].edited_fingerprint:
            assert got[d].near_edited == 1
    marks = {}
    for d, text in order:
        assert marks.setdefault(text, got[d].fingerprint) == got[d].fingerprint


def test_order_of_documents_over_many_slices(docs, rows, monkeypatch):
    whole = {r.doc_id: tuple(r) for r in spotsigs.fingerprint_report(docs).collect()}
    monkeypatch.setattr(spotsigs, "_SLICE_DOCS", 3)
    assert {r.doc_id: tuple(r) for r in spotsigs.fingerprint_report(docs).collect()} == whole


def test_fingerprints_of_odd_rows(odd, none, docs):
    assert spotsigs.fingerprint_report(odd).count() == odd.count()
    assert spotsigs.fingerprint_report(none).count() == 0
    alone = spotsigs.fingerprint_report(docs.filter("doc_id = 0")).first()
    assert alone.near_next == 1
    assert spotsigs.near_pairs(none).count() == 0


def test_near_fingerprints_match_brute_force(docs):
    sets = {frozenset(r.s): r.f for r in docs.select(
        spotsigs.signatures(F.coalesce("text", F.lit(""))).alias("s")).select(
        "s", spotsigs.label(F.col("s")).alias("f")).collect() if r.s}
    keys = list(sets)
    want = {tuple(sorted((sets[a], sets[b]))) for i, a in enumerate(keys) for b in keys[i + 1:]
            if len(a & b) / len(a | b) >= 0.5}
    got = {(r[0], r[1]) for r in spotsigs.near_pairs(docs, 0.5).collect()}
    assert want and got == want
