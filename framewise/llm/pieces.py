"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here (pieces with scores and types, trainer
and normaliser settings) and rebuilt as a tokenizer: the normaliser with its
character map, the marker U+2581 for spaces with its dummy prefix, unigram
scores or, for a merge model, merges ranked by the score of what they make,
and byte fallback.  Batches are encoded by the library's threads.

A merge model encodes a text as one word.  If no piece holds the marker after
another character (checked on the model), no merge crosses such a place, so
the text may be cut there first: the same ids, found word by word.

The model file is read by Spark from any store it reads and sent to the tasks;
its size is checked against ``MAX_MODEL``.

Defined results.  Null or empty text: no ids.  Null or repeated ids: every row
by itself.  Empty table: empty result.  Input columns pass through; result
columns replace equal names.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from framewise.llm.common import bounded_batches, flat

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Largest model file that is broadcast.
MAX_MODEL = 64 << 20
#: Characters given to one call of the library.
CALL_CHARS = 1 << 20
THREADS = 2
MARK = "▁"

#: Piece types and model types of the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(raw: bytes):
    """(number, value) of a protobuf message: ints, or bytes."""
    at, n = 0, len(raw)

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield key >> 3, raw[at:at + size]
        at += size


class Model:
    """What a model file says.  Field numbers and defaults are the format's."""

    def __init__(self, raw: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback = UNIGRAM, False
        self.dummy_prefix = self.remove_extra = self.escape = True
        self.charsmap = b""
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                self.kind, self.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                self.charsmap = spec.get(2, b"")
                self.dummy_prefix, self.remove_extra, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)

    def merges(self) -> list[tuple[str, str]]:
        """Every cut of a piece into two pieces, best scores first."""
        ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)}
        ranked = []
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                a, b = ids.get(piece[:k]), ids.get(piece[k:])
                if a is not None and b is not None:
                    ranked.append((-self.pieces[i][1], i, a, b, piece[:k], piece[k:]))
        return [m[4:] for m in sorted(ranked)]

    def tokenizer(self) -> Tokenizer:
        unknown = None if self.unknown is None else self.pieces[self.unknown][0]
        if self.kind == BPE:
            core = models.BPE({p: i for i, (p, _, _) in enumerate(self.pieces)}, self.merges(),
                              unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
        elif self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            raise ValueError("only unigram and merge models are known")
        out = Tokenizer(core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.remove_extra:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        if not any(MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind in (NORMAL, USER)):
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        # marks go after the pieces are one string: once a text, not once a piece
        undo = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")]
        out.decoder = decoders.Sequence(undo + [decoders.Strip(" ", 1, 0)] * self.dummy_prefix)
        user = [AddedToken(p, normalized=True) for p, _, kind in self.pieces if kind == USER]
        if user:
            out.add_tokens(user)
        return out


@functools.lru_cache(maxsize=2)
def _loaded(raw: bytes, threads: int) -> Tokenizer:
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    return Model(raw).tokenizer()


def encode_texts(raw: bytes, texts: list[str], threads: int = 1) -> list[list[int]]:
    return [e.ids for e in _loaded(raw, threads).encode_batch_fast(texts, add_special_tokens=False)]


def decode_ids(raw: bytes, ids: list[list[int]], threads: int = 1) -> list[str]:
    return _loaded(raw, threads).decode_batch(ids, skip_special_tokens=False)


def _calls(texts: list[str]):
    """Runs of texts of bounded length."""
    run: list[str] = []
    size = 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= CALL_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


_NEW = (("n_tokens", T.LongType()), ("input_ids", T.ArrayType(T.IntegerType(), False)),
        ("ids_sha256", T.StringType()), ("round_trip", T.BooleanType()))


def _encode(batches, model, text: str, threads: int):
    raw, new = model.value, [n for n, _ in _NEW]
    for batch in batches:
        rest = [f for f in batch.schema.names if f not in new and f != text]
        at = 0
        for texts in _calls([t or "" for t in flat(batch, text).to_pylist()]):
            ids = encode_texts(raw, texts, threads)
            same = [a == b for a, b in zip(texts, decode_ids(raw, ids, threads), strict=True)]
            numbers = [np.array(x, "<i4") for x in ids]
            sizes = np.array([len(x) for x in ids])
            listed = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(np.concatenate(numbers)),
                type=pa.list_(pa.field("element", pa.int32(), False)))
            part = batch.slice(at, len(texts))
            at += len(texts)
            yield pa.RecordBatch.from_arrays(
                [*(flat(part, f) for f in rest), pa.array(sizes.astype(np.int64)), listed,
                 pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in numbers]), pa.array(same)],
                names=[*rest, *new])


def model_bytes(spark, path: str = MODEL) -> bytes:
    row = spark.read.format("binaryFile").load(path).select("length", "content")
    if row.select("length").first()[0] > MAX_MODEL:
        raise ValueError(f"{path} is larger than {MAX_MODEL} bytes")
    return bytes(row.first()["content"])


def encode(docs: DataFrame, model_path: str = MODEL, text: str = "text", threads: int = THREADS) -> DataFrame:
    """``docs`` with ``n_tokens``, ``input_ids``, ``ids_sha256`` (of the ids as
    little-endian 32-bit numbers) and ``round_trip`` (whether decoding gives
    the text back) in place of the text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(model_bytes(spark, model_path))
    new = [n for n, _ in _NEW]
    rest = [f for f in docs.schema.fields if f.name != text and f.name not in new]
    schema = T.StructType([*rest, *(T.StructField(n, t) for n, t in _NEW)])
    return docs.select(*[f.name for f in rest], text).mapInArrow(
        lambda it: _encode(it, model, text, threads), schema)


def _decode(batches, model, ids: str, text: str):
    for batch in batches:
        texts = decode_ids(model.value, [x or [] for x in flat(batch, ids).to_pylist()])
        rest = [f for f in batch.schema.names if f != text]
        yield pa.RecordBatch.from_arrays([*(flat(batch, f) for f in rest), pa.array(texts, pa.string())],
                                         names=[*rest, text])


def decode(encoded: DataFrame, model_path: str = MODEL, ids: str = "input_ids", text: str = "text") -> DataFrame:
    """``encoded`` with its ids decoded into ``text``; null ids give the empty text."""
    spark = encoded.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(model_bytes(spark, model_path))
    rest = [f for f in encoded.schema.fields if f.name != text]
    return encoded.select(*[f.name for f in rest]).mapInArrow(
        lambda it: _decode(it, model, ids, text), T.StructType([*rest, T.StructField(text, T.StringType())]))
