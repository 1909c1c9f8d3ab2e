"""Phrase collocations from stripes.

A *stripe* is a prefix of words with an associative counter of the words that
follow it inside a piece of text.  Level k counts the stripes of k-word
prefixes: level 0 has one stripe per language (the word counts), level 1 the
followers of a word, level 2 those of a word pair.  Each task builds stripes
of some megabytes of text, the stripes of one prefix meet in a shuffle and are
merged element by element in sorted order.  The merged stripes hold all that
is asked for: an entry is the count of the phrase prefix + word, the entries
of an earlier level are the prefix totals, a stripe's largest entry is what
the prefix's best extension to the right has, and the largest entry by
(rest of prefix, word) is that of the best extension to the left.

* A phrase can reach ``least`` only if its words without the last and without
  the first do.  The phrases of a level that reach it set bits of a map of
  fixed size (16 MB, broadcast); positions whose two bits are not both set are
  left out at the next level.  A wrong bit costs a row, never a result.
* A prefix with more than 1/1000 of all words is heavy (at most 1000 are, by
  that definition); its stripe is cut into slices by the follower's hash, so
  no task holds one prefix's whole counter.
* Words are 64-bit hashes until the end (of language and lower-cased word);
  level 0 keeps the words themselves for the phrases that are returned.

Defined results.  Null text: empty.  Null language: ``und``.  Ties of score
and count: by phrase.  Repeated rows and ids: every row counts.  Empty table:
empty result.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.common import (bounded_batches, byte_codes, flat, keep_scratch, mix, signed, utf8,
                                  word_hashes, write_scratch)
from framewise.session import scratch_written

#: Bytes that end a piece, and the bits of the map of phrases that reach the least count.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MAP_BITS = 27
#: Bytes of text of which a task builds stripes before it hands them on.
STRIPE_BYTES = 8 << 20
HEAVY_SHARE = 1000
HEAVY_SLICES = 256
WORD_SLICES = 1024

_STRIPES = "key long, slice int, lang string, prefix array<long>, next array<long>, n array<long>, words array<string>"
_MERGED = ("key long, lang string, prefix array<long>, total long, next array<long>, n array<long>, "
           "code array<long>, words array<string>")
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def _joined(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Code of a phrase and one more word."""
    return mix(code * _FACTOR + word)


def _bit(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(64 - MAP_BITS)).astype(np.int64)


# ---------------------------------------------------------------- building stripes

def _lists(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)


def _strings(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    """The bytes data[s:e] of every word, A-Z in lower case."""
    size = e - s
    offsets = np.zeros(len(s) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    raw = data[np.repeat(s - offsets[:-1], size) + np.arange(offsets[-1])]
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    return pa.StringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(raw))


def _stripes_of(batch: pa.RecordBatch, level: int, reached: np.ndarray | None,
                heavy: np.ndarray) -> pa.RecordBatch:
    data, offsets = utf8(flat(batch, "text"))
    codes = byte_codes("space", True).copy()
    codes[list(PIECE_ENDS)] = 0
    h, s, e, first = word_hashes(data, offsets, codes)
    langs = flat(batch, "lang").dictionary_encode()
    names = langs.dictionary
    of_lang = np.array([xxhash.xxh64_intdigest(x.as_py()) for x in names], np.uint64)
    lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(first))
    word = mix(h ^ of_lang[lang]) if len(h) else h

    # goes_on[i]: word i + 1 follows in the same piece; code[i]: the phrase of ``level`` words from word i on
    ends = np.zeros(len(data) + 1, np.int32)
    np.cumsum(np.isin(data, np.frombuffer(PIECE_ENDS, np.uint8)), out=ends[1:])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    goes_on = np.zeros(len(word), bool)
    goes_on[:-1] = (ends[e[:-1]] == ends[s[1:]]) & (doc[1:] == doc[:-1])
    if level == 0:
        at = np.arange(len(word))
        key = of_lang[lang] if len(word) else word
    else:
        at, code = np.arange(len(word)), word
        for k in range(1, level):
            at = at[goes_on[at + k - 1]]
            code = _joined(code[at] if k > 1 else word[at], word[at + k])
            full = np.zeros(len(word), np.uint64)
            full[at] = code
            code = full
        may = np.zeros(len(word), bool)
        may[at] = reached[_bit(code[at]) >> 3] >> (_bit(code[at]) & 7).astype(np.uint8) & 1
        at = at[goes_on[at + level - 1] & may[at]]
        at = at[may[at + 1]]  # the phrase without its first word starts one word later
        key = code[at]
    follows = word[at + level]
    _, one, n = np.unique(_joined(key, follows), return_index=True, return_counts=True)
    key, follows, at = key[one], follows[one], at[one]
    part = (follows % np.uint64(WORD_SLICES) if level == 0 else
            np.where(np.isin(key, heavy), follows % np.uint64(HEAVY_SLICES), np.uint64(0))).astype(np.int32)
    order = np.lexsort((part, key))
    key, follows, at, n, part = key[order], follows[order], at[order], n[order], part[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    starts = np.append(np.flatnonzero(new), len(key)).astype(np.int32)
    heads = at[new]
    prefix = np.stack([word[heads + i] for i in range(level)], 1).ravel() if level else np.zeros(0, np.uint64)
    texts = _strings(data, s[at], e[at]) if level == 0 else pa.array([], pa.string())
    return pa.RecordBatch.from_arrays([
        pa.array(signed(key[new])), pa.array(part[new]), names.take(pa.array(lang[heads], pa.int32())),
        _lists(pa.array(signed(prefix)), np.arange(len(heads) + 1) * level),
        _lists(pa.array(signed(follows)), starts), _lists(pa.array(n.astype(np.int64)), starts),
        _lists(texts, starts if level == 0 else np.zeros(len(heads) + 1))],
        names=["key", "slice", "lang", "prefix", "next", "n", "words"])


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``size`` bytes."""
    held, have = [], 0
    for b in batches:
        held.append(b)
        have += b.nbytes
        if have >= size:
            yield pa.concat_batches(held)
            held, have = [], 0
    if held:
        yield pa.concat_batches(held)


# ---------------------------------------------------------------- merging stripes

def _merge(rows: pa.RecordBatch, least: int, level: int) -> pa.RecordBatch:
    """One stripe for each (key, slice) of rows sorted by them; entries under
    ``least`` are gone, ``total`` counts them."""
    key, part = (flat(rows, c).to_numpy() for c in ("key", "slice"))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    heads = np.flatnonzero(new)
    n_entries = pc.list_value_length(flat(rows, "next")).to_numpy()
    group = np.repeat(np.cumsum(new) - 1, n_entries)
    follows = pc.list_flatten(flat(rows, "next")).to_numpy()
    n = pc.list_flatten(flat(rows, "n")).to_numpy()
    order = np.lexsort((follows, group))
    group, follows, n = group[order], follows[order], n[order]
    first = np.ones(len(group), bool)
    first[1:] = (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])
    at = np.flatnonzero(first)
    n = np.add.reduceat(n, at) if len(at) else n
    group, follows, total = group[at], follows[at], np.zeros(len(heads), np.int64)
    np.add.at(total, group, n)
    keep = n >= least
    starts = np.searchsorted(group[keep], np.arange(len(heads) + 1)).astype(np.int32)
    words = pa.array([], pa.string())
    if level == 0:
        words = pc.list_flatten(flat(rows, "words")).take(pa.array(order[at][keep]))
    head = pa.array(heads)
    code = follows if level == 0 else signed(_joined(
        key[heads][group].view(np.uint64), follows.view(np.uint64)))
    return pa.RecordBatch.from_arrays([
        flat(rows, "key").take(head), flat(rows, "slice").take(head), flat(rows, "lang").take(head),
        flat(rows, "prefix").take(head), pa.array(total),
        _lists(pa.array(follows[keep]), starts), _lists(pa.array(n[keep]), starts),
        _lists(pa.array(code[keep]), starts),
        _lists(words, starts if level == 0 else np.zeros(len(heads) + 1))],
        names=["key", "slice", "lang", "prefix", "total", "next", "n", "code", "words"])


def _merged(batches: Iterator[pa.RecordBatch], least: int, level: int) -> Iterator[pa.RecordBatch]:
    """Merge sorted stripe rows as they come; the last group of a batch waits,
    merged to one row, for what the next batch adds to it."""
    names = ["key", "slice", "lang", "prefix", "next", "n", "words"]
    out = ["key", "lang", "prefix", "total", "next", "n", "code", "words"]
    waits = None
    for b in batches:
        b = b.select(names)
        rows = pa.concat_batches([waits.cast(b.schema), b]) if waits is not None else b
        key, part = (flat(rows, c).to_numpy() for c in ("key", "slice"))
        other = np.flatnonzero((key != key[-1]) | (part != part[-1])) if len(key) else []
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield _merge(rows.slice(0, cut), least, level).select(out)
        waits = _merge(rows.slice(cut), 1, level).select(names) if len(key) else None
    if waits is not None:
        yield _merge(waits, least, level).select(out)


# ---------------------------------------------------------------- levels

def count_stripes(docs: DataFrame, level: int, least: int, reached=None, heavy=()) -> DataFrame:
    """The merged stripes of ``level``-word prefixes as a written table: (key,
    lang, prefix, total, next, n, code, words).  ``docs``: (lang, text)."""
    heavy = np.array(list(heavy), np.int64).view(np.uint64)

    def build(batches):
        bits = None if reached is None else reached.value
        for b in _gathered(batches, STRIPE_BYTES):
            yield _stripes_of(b, level, bits, heavy)

    rows = docs.mapInArrow(build, _STRIPES).repartition("key", "slice").sortWithinPartitions("key", "slice")
    out = rows.mapInArrow(lambda it: _merged(it, least, level), _MERGED)
    return write_scratch(out if level == 0 else out.where(F.size("next") > 0), f"stripes-{level}")


def _map_of(stripes: DataFrame):
    """Broadcast map with the bits of all phrases of the stripes, of fixed size."""
    bit = F.shiftrightunsigned("code", 64 - MAP_BITS) + 1  # its buckets start at 1
    parts = stripes.select(F.explode("code").alias("code")).select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toArrow()
    out = np.zeros((1 << MAP_BITS - 15, 4096), np.uint8)
    for part, bits in zip(parts["part"].to_pylist(), parts["bits"].to_pylist(), strict=True):
        out[part - 1] = np.frombuffer(bits, np.uint8)
    return stripes.sparkSession.sparkContext.broadcast(out.ravel())


def phrase_counts(docs: DataFrame, max_words: int, least: int) -> list[DataFrame]:
    """The stripes of levels 0 to ``max_words - 1``."""
    bounded_batches(docs.sparkSession)
    levels = [count_stripes(docs, 0, least)]
    total = levels[0].agg(F.coalesce(F.sum("total"), F.lit(0))).scalar()
    for level in range(1, max_words):
        of = levels[-1].select(F.explode(F.arrays_zip("code", "n")).alias("x"))
        # by its definition no more than HEAVY_SHARE phrases are heavy
        heavy = of.where(F.col("x.n") * HEAVY_SHARE > total).select("x.code").toArrow()["code"].to_pylist()
        levels.append(count_stripes(docs, level, least, _map_of(levels[-1]), heavy))
    return levels


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, percent: int = 50, top: int = 2000,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Candidates are phrases of 2 to ``max_words`` words found ``least`` times.
    A phrase's score is that of its lowest cut, 1000000 a a / (l r) rounded
    down; those of which a longer candidate has ``percent`` % go.
    """
    mark = scratch_written(docs.sparkSession)
    read = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    levels = phrase_counts(read, max_words, least)
    entry = F.explode(F.arrays_zip("next", "n")).alias("x")
    counts, longer = [], []
    for level, stripes in enumerate(levels):
        counts.append(stripes.select("lang", "prefix", entry).select(
            "lang", F.concat("prefix", F.array("x.next")).alias("p"), F.col("x.n").alias("n")))
        if level >= 2:  # a stripe's largest entry extends its prefix, the others extend what follows the first word
            longer.append(stripes.select(F.col("prefix").alias("p"), F.array_max("n").alias("most")))
            longer.append(counts[-1].select(F.slice("p", 2, level).alias("p"), F.col("n").alias("most")))
    shorter = counts[0]
    for c in counts[1:-1]:
        shorter = shorter.unionByName(c)
    wanted = counts[1]
    for c in counts[2:]:
        wanted = wanted.unionByName(c)
    if longer:
        best = longer[0]
        for b in longer[1:]:
            best = best.unionByName(b)
        best = best.groupBy("p").agg(F.max("most").alias("most"))
        wanted = wanted.join(best, "p", "left").where(
            F.col("most").isNull() | (100 * F.col("most") < percent * F.col("n"))).drop("most")
    part = shorter.select(F.col("p").alias("part"), F.col("n").alias("m"))
    cut = wanted.select("lang", "p", F.col("n").alias("a"), F.explode(
        F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.withColumn("rest", F.expr("slice(p, k + 1, size(p) - k)")).withColumn(
        "first", F.expr("slice(p, 1, k)"))
    cut = (cut.join(part.withColumnsRenamed({"part": "first", "m": "l"}), "first")
           .join(part.withColumnsRenamed({"part": "rest", "m": "r"}), "rest"))
    whole = "decimal(15,0)"  # words of any corpus; the products fit 38 digits
    score = F.expr(f"(cast(a as {whole}) * cast(a as {whole}) * cast(1000000 as decimal(7,0))) div "
                   f"(cast(l as {whole}) * cast(r as {whole}))")
    scored = cut.withColumn("score", score).groupBy("lang", "p", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("c"))
    words = levels[0].select(F.explode(F.arrays_zip("next", "words")).alias("x")).select(
        F.col("x.next").alias("w"), F.col("x.words").alias("word"))
    named = (scored.select("*", F.posexplode("p").alias("i", "w")).join(words, "w")
             .groupBy("p").agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("c").alias("c"),
                               F.array_sort(F.collect_list(F.struct("i", "word"))).alias("ws")))
    named = named.select("lang", F.array_join("ws.word", " ").alias("phrase"), "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    out = ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    out = write_scratch(out, "collocations")
    keep_scratch(docs.sparkSession, mark, out)
    return out
