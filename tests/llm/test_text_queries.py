"""Registry of the text queries and the corpus pipeline over the bundled tables."""

import compare
import corpus_pipeline
import pytest

from eventloom.llm import queries as text

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = list(text.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(text.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(text.oracle_sql()))
def test_checking_sql(spark, name):
    found = text.queries()[name](spark, SF)
    assert compare.diff(found, compare.connect(SF), text.oracle_sql()[name]) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "suffix_array_dedup",
                     "best_fit_packing"]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.store(stage(spark, at, SF), name)
        assert at.columns == docs.columns
    kept = {r.doc_id for r in at.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF).collect()
    assert {r.doc_id for r in packed} == kept and 0 < len(kept) < docs.count()
