"""Parity of the rebuilt tokenizer with the format's own library."""

import sys
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewise.llm import pieces, queries

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def raw():
    return open(pieces.MODEL, "rb").read()


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_parity_on_the_whole_small_table(spark, sf_small, own):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = pieces.encode(spark.read.parquet(f"{sf_small}/documents.parquet")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.input_ids == own.encode(docs[r.doc_id]) and r.round_trip and r.n_tokens == len(r.input_ids)
    assert queries.op4_sentencepiece(spark, sf_small).count() == len(docs)


def test_parity_on_odd_texts(raw, own):
    texts = ["", " ", "   ", "a", " a", "a  b ", "\n\t", "a\x00b", "é中文🦊́", "<s></s><unk><0x0A>", "▁", "a▁ b",
             "x" * 3000, "\r\n", "Ünïcödé ß ñ", "  leading and trailing  ", "1234567890.,;:!?"]
    assert pieces.encode_texts(raw, texts) == own.encode(texts)
    back = pieces.decode_ids(raw, own.encode(texts))
    assert [b for b, t in zip(back, texts) if "▁" not in t] == [t for t in texts if "▁" not in t]


def test_edges(spark, edge, empty, own):
    got = pieces.encode(edge).collect()
    rows = {r.doc_id: r.text for r in edge.collect()}
    assert len(got) == edge.count() and all(r["__odd"] == "own" for r in got)
    for r in got:
        assert r.input_ids == own.encode(rows[r.doc_id] or "")
    assert pieces.encode(empty).count() == 0
    back = pieces.decode(pieces.encode(edge).withColumn("text", F.lit("clash"))).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in rows.items()}


def test_round_trip_decodes(raw, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": ["one two", "", None, "caf\u00e9 \U0001f98a"]})
    rows = lambda: [x for b in pieces._encode([batch], SimpleNamespace(value=raw), "text", 1)
                    for x in b.column("round_trip").to_pylist()]
    assert rows() == [True] * 4
    whole = pieces.decode_ids
    monkeypatch.setattr(pieces, "decode_ids", lambda *a: [t[1:] for t in whole(*a)])
    assert rows() == [False, True, True, False]  # a decoder that loses text is seen


def _number(field, value):
    out, value = bytes([field << 3]) if field < 16 else bytes([(field << 3) & 127 | 128, field >> 4]), value
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def _message(field, raw):
    n, size = len(raw), b""
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return bytes([field << 3 | 2]) + size + bytes([n]) + raw


def test_unigram_model(tmp_path):
    """A hand-made unigram model: parsed, rebuilt, best path by scores."""
    import struct
    pieces_ = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -2.5, 1), ("▁", -4.0, 1), ("a", -3.0, 1),
               *((f"<0x{i:02X}>", -9.0, 6) for i in range(256))]
    raw = b"".join(_message(1, _message(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + _number(3, k))
                   for p, s, k in pieces_)
    raw += _message(2, _number(3, 1) + _number(35, 1)) + _message(3, _number(3, 1) + _number(4, 0) + _number(5, 1))
    m = pieces.Model(raw)
    assert (m.kind, m.byte_fallback, m.unknown, len(m.pieces)) == (1, True, 0, 262)
    texts = ["ab", "a b", "aab", "é", ""]
    mine = pieces.encode_texts(raw, texts)
    assert mine[0] == [3] and mine[1] == [1, 4, 2] and mine[4] == []
    own = sentencepiece.SentencePieceProcessor(model_proto=raw)
    assert mine == own.encode(texts)
    assert pieces.decode_ids(raw, mine) == texts


def test_no_protobuf_needed():
    assert "google.protobuf" not in {m for m in sys.modules if m in vars(pieces)}
