"""Named queries of the text operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    concat,
    dropout,
    hmm,
    licenses,
    lines,
    negatives,
    packing,
    passages,
    quality,
    resampling,
    simhash,
    spotsigs,
    topk,
)
from eventloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _op1(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.fingerprint_report(table(spark, sf, "documents"))


def _op2(spark: SparkSession, sf: str) -> DataFrame:
    return passages.removal_report(table(spark, sf, "documents"))


def _op3(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"), licenses.template_table(spark))


def _op4(spark: SparkSession, sf: str) -> DataFrame:
    return dropout.round_trip(table(spark, sf, "documents"))


def _op5(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.language_scores(table(spark, sf, "documents"))


def _op6(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_products(table(spark, sf, "embeddings"))


def _op7(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf, "documents"))


def _op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.quality_scores(docs, quality.learn(docs, table(spark, sf, "labels")))


def _op9(spark: SparkSession, sf: str) -> DataFrame:
    return lines.line_report(table(spark, sf, "documents"))


def _op10(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def _op11(spark: SparkSession, sf: str) -> DataFrame:
    found = resampling.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _op12(spark: SparkSession, sf: str) -> DataFrame:
    return concat.cut_pieces(table(spark, sf, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset")


def _op13(spark: SparkSession, sf: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf, "embeddings"), negatives.shifted_labels)


def queries() -> dict[str, Query]:
    return {
        "op1_spot_signatures": _op1,
        "op2_suffix_array_dedup": _op2,
        "op3_license_scan": _op3,
        "op4_piece_dropout": _op4,
        "op5_hmm_scores": _op5,
        "op6_exact_topk": _op6,
        "op7_best_fit_packing": _op7,
        "op8_quality_classifier": _op8,
        "op9_line_dedup": _op9,
        "op10_simhash_near_dedup": _op10,
        "op11_importance_resampling": _op11,
        "op12_concat_packing": _op12,
        "op13_hard_negatives": _op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_topk": _OP6_SQL, "op13_hard_negatives": _OP13_SQL}


_OP6_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.ints) = len(c.ints)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP13_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
one AS (SELECT vec_id, min({'ints': ints, 'label': label}) AS r FROM usable GROUP BY vec_id),
v AS (SELECT vec_id, r.label AS label, r.ints AS ints FROM one),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id AS vec_id, c.label AS label,
    CAST(coalesce(list_sum(list_transform(list_zip(a.ints, c.ints), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.ints) = len(c.ints)
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""
