"""Concatenate-and-cut packing: ids against the tokenizer, sequences rebuilt from their pieces."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventloom.llm import concat, prefix
from eventloom.llm import queries as text

WHOLE = Tokenizer.from_file(concat.TOKENIZER)


def plain(t):
    return np.array([*WHOLE.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")


def checked(pieces, rows, size):
    """Pieces rebuild every text and fill sequences without gap; only the last may be short."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert sorted(by_doc) == sorted(d for d, _ in rows)
    for doc, t in rows:
        want, at = plain(t), 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want)
            assert bytes(p.ids) == want[at:at + p.length].tobytes()
            at += p.length
        assert at == len(want)
    filled = []
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        filled.append(at)
    assert sorted(filled)[1:] == [size] * (len(filled) - 1) and max(filled) <= size


@pytest.mark.parametrize("size", [2048, 64, 7, 1])
def test_pieces_hold_all_ids_and_fill_windows(docs, rows, size):
    checked(concat.cut_pieces(docs, size).collect(), rows, size)


def test_order_of_the_concatenation_follows_parts(spark, rows):
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(37)
    checked(concat.cut_pieces(many, 100).collect(), rows, 100)


def test_sequences_are_the_pieces_joined(docs, rows):
    pieces = concat.cut_pieces(docs, 50).cache()
    want = defaultdict(bytes)
    for p in sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset)):
        want[p.sequence_id] += bytes(p.ids)
    got = {r.sequence_id: (r.length, bytes(r.ids)) for r in concat.sequences(pieces, 50).collect()}
    assert got == {k: (len(v) // 4, v) for k, v in want.items()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\ta'sé9.日\x1c\x85　<|endoftext|>", max_size=40))
def test_ids_are_those_of_the_tokenizer(t):
    assert IDS.encode(t) == plain(t)[:-1].tobytes()


IDS = concat.Ids(concat.TOKENIZER, concat.RANKS)


def test_special_tokens_and_every_plane():
    assert IDS.encode("a <|endoftext|> b") == plain("a <|endoftext|> b")[:-1].tobytes()
    points = [c for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 500):
        t = " ".join(f"{chr(c)}a{chr(c)}1" for c in points[at:at + 500])
        assert IDS.encode(t) == plain(t)[:-1].tobytes()


def test_totals_are_joined_without_a_broadcast_too(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix, "TOLD_PARTS", 0)
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    checked(concat.cut_pieces(many, 100).collect(), rows, 100)


def test_odd_rows_and_empty_tables(odd, none):
    got = concat.cut_pieces(odd, 128).collect()
    total = sum(len(plain(r.text)) for r in odd.select("text").collect())
    assert sum(p.length for p in got) == total
    places = sorted((p.sequence_id * 128 + p.offset, p.length) for p in got)
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
    assert concat.cut_pieces(none).collect() == []
    assert concat.sequences(concat.cut_pieces(none)).collect() == []


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = text.queries()["op12_concat_packing"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][r.start:r.start + r.length].tobytes())
