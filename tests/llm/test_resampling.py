"""Importance resampling against a plain version, and its pieces by themselves."""

import zlib

import brute
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.llm import prefix, resampling

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def found(docs, target, **options):
    return sorted((tuple(r) for r in resampling.resampled(docs, target, **options).select(*COLUMNS).collect()),
                  key=repr)


@pytest.fixture(scope="module")
def target(spark, rows):
    texts = [rows[2][1], rows[9][1], None, "", "Été the OF x9 " * 5]
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


def test_equals_the_plain_version(docs, rows, target):
    texts = [r.text for r in target.collect()]
    for share in (5, 40):
        want = brute.resampled(rows, texts, share=share)
        assert found(docs, target, share=share) == sorted(want, key=repr)
    assert max(r[4] or 0 for r in want) > 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é9.-\x00\x7f日", max_size=30)), max_size=8))
def test_crcs_of_all_ngrams(texts):
    rows, words = resampling.split_words(pa.array(texts, pa.string()))
    got = sorted(
        (r, c) for owner, crcs in resampling.ngram_crcs(rows, words)
        for r, c in zip(owner.tolist(), crcs.tolist()))
    assert got == sorted((k, zlib.crc32(g)) for k, t in enumerate(texts) for g in brute.ngrams(t))


def test_odd_rows(odd, target):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = found(odd, target, share=60)
    want = sorted(brute.resampled(rows, [r.text for r in target.collect()], share=60), key=repr)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    # Ranks run from 1 without a gap, copies of a row included.
    ranks = sorted(r[4] for r in got if r[4] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 5


def test_ties_go_to_the_smaller_id_and_null_comes_last(spark):
    ids = spark.createDataFrame([(k,) for k in [5, 3, None, 9, 1]], "doc_id long").withColumn("score", F.lit(7))
    got = prefix.ranked(ids, [F.desc("score"), F.asc_nulls_last("doc_id")], "rank").collect()
    assert sorted((r.rank, r.doc_id) for r in got) == [(1, 1), (2, 3), (3, 5), (4, 9), (5, None)]


def test_empty_tables(docs, none, target):
    assert found(none, target) == []
    bare = found(docs, target.limit(0))
    assert len(bare) == docs.count()


def test_selected_documents_keep_their_columns(docs, target):
    drawn = {r[0] for r in found(docs, target, share=30) if r[4]}
    kept = resampling.selected(docs, target, share=30)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn


def test_target_texts_are_preferred(spark):
    words = [" ".join(f"{kind}{(k * j) % 50}" for j in range(30)) for k in range(200) for kind in "ab"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(words)], "doc_id long, text string")
    target = docs.filter("doc_id % 2 = 0 AND doc_id < 40").select(F.col("doc_id").alias("item_id"), "text")
    drawn = resampling.resampled(docs, target, share=20).filter("rank IS NOT NULL").collect()
    assert len(drawn) == 80 and sum(r.doc_id % 2 == 0 for r in drawn) >= 78


def test_totals_before_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix, "FAN", 4)
    parts = spark.createDataFrame([(p, p + 1) for p in range(0, 40, 3)], "part long, n long")
    got = {r.part: r.before for r in prefix.totals_before(parts, "n").collect()}
    assert got == {p: sum(q + 1 for q in range(0, p, 3)) for p in range(0, 40, 3)}
