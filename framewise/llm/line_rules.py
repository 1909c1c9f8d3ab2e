"""Quality rules: base rules on a text and line frequency across documents.

Cross-document part: every line is normalised and hashed, the distinct
documents that hold it are counted per host, lines above ``max_docs`` are
removed, and a document that the removal depletes is rejected.  A document
counts by its content, the hash of its normalised lines: copies are one
document, so that a group of them does not make its own body look like
boilerplate (copies are the business of near-duplicate removal, not of this
rule).  Texts that differ in a line are different documents.

A line above the limit stays in the document with the smallest id of its host
and goes from the others.  Each (host, line, content) is pre-aggregated before
its shuffle and again before the count's shuffle, so a line that a third of
all documents hold never meets in one task.

Defined results.  Null or empty text: no words, fails the base rules.  Null
host: a host of its own.  Null or repeated ids: every row is judged by itself;
rows equal in id, host and text get the same verdict.  Empty table: empty
result.  Input columns pass through; result columns replace equal names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.common import (SPACE_CHARS, bounded_batches, byte_codes, flat, fresh,
                                  maybe_broadcast, mix, utf8, word_hashes, write_scratch)
from framewise.llm.line_dedup import line_key, lines_of

#: Distinct documents per host beyond which a line is boilerplate.
MAX_DOCS = 100
#: Share of a text's characters that must be left after the removal.
MIN_LEFT = 0.1
MIN_WORDS = 50
#: Percent of words that may stand in repeated three-word windows.
MAX_REPEAT_PCT = 50
#: Rows of 16 bytes up to which removed lines are broadcast (64 MB).
BROADCAST_ROWS = 4_000_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def repeat_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, its words within three-word windows found at least twice in
    it.  ``h``: word hashes, ``first``: index of each text's first word."""
    n, texts = len(h), len(first) - 1
    out = np.zeros(texts, np.int64)
    if n < 3:
        return out
    doc = np.repeat(np.arange(texts), np.diff(first))
    whole = doc[:-2] == doc[2:]
    at = np.flatnonzero(whole)
    w = mix(mix(mix(h[:-2] + np.uint64(1)) ^ h[1:-1]) + h[2:])[at]
    key = mix(w ^ mix(doc[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[at[twice] + k] = True
    return np.bincount(doc[hit], minlength=texts)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier line."""
    out = np.zeros(len(offsets) - 1, np.int64)
    breaks = np.flatnonzero(data == 10)
    many = np.searchsorted(breaks, offsets)
    for i in np.flatnonzero(np.diff(many)):
        text = data[offsets[i]:offsets[i + 1]].tobytes()
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line in seen:
                out[i] += 1
            elif line.split():
                seen.add(line)
    return out


def _stats(batches, text: str):
    codes = byte_codes("space", False)
    for batch in batches:
        data, offsets = utf8(flat(batch, text))
        h, s, _, first = word_hashes(data, offsets, codes)
        letters = (data & 0xC0) != 0x80  # first bytes of code points
        letters &= codes[data] != 0

        def per_text(flags):
            total = np.zeros(len(flags) + 1, np.int64)
            np.cumsum(flags, out=total[1:])
            return total[offsets[1:]] - total[offsets[:-1]]

        columns = dict(zip(STATS, (
            np.diff(first), per_text(letters), per_text(_SYMBOLS[data]),
            duplicate_lines(data, offsets, s), repeat_words(h, first)), strict=True))
        yield pa.RecordBatch.from_arrays(
            [*(flat(batch, f) for f in batch.schema.names if f != text),
             *(pa.array(c.astype(np.int64)) for c in columns.values())],
            names=[*(f for f in batch.schema.names if f != text), *columns])


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics in place of the text."""
    bounded_batches(docs.sparkSession)
    rest = docs.drop(*(c for c in docs.columns if c in STATS))
    fields = [f for f in rest.schema.fields if f.name != text]
    schema = T.StructType(fields + [T.StructField(c, T.LongType()) for c in STATS])
    return rest.mapInArrow(lambda it: _stats(it, text), schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def frequent_lines(docs: DataFrame, host: str, id_col: str, text: str, max_docs: int) -> DataFrame:
    """Hashes ``a``, ``b`` of (host, line) in more than ``max_docs`` documents of
    different content, and the smallest id ``first`` that holds the line."""
    keys = F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: k != "")
    held = docs.select(F.col(host).alias("host"), F.col(id_col).alias("id"), keys.alias("k")).select(
        "host", "id", F.xxhash64("k").alias("c"), F.explode(F.array_distinct("k")).alias("key"))
    rows = held.select(F.xxhash64("host", "key").alias("a"), F.xxhash64(F.lit(1), "host", "key").alias("b"), "c", "id")
    return (rows.groupBy("a", "b", "c").agg(F.min("id").alias("id"))
            .groupBy("a", "b").agg(F.count("*").alias("n"), F.min("id").alias("first"))
            .where(F.col("n") > max_docs).select("a", "b", "first"))


def judge(docs: DataFrame, host: str = "source", id_col: str = "doc_id", text: str = "text",
          max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """``docs`` without their text, with the base statistics, ``base_failed``,
    ``boiler_chars`` (characters of removed lines) and ``kept``."""
    doc, tag = fresh("doc"), fresh("tag")
    frequent = write_scratch(frequent_lines(docs, host, id_col, text, max_docs), "line-rules")
    named = docs.withColumns({
        doc: F.xxhash64(F.col(id_col), F.col(host)),
        tag: F.xxhash64(F.lit(7), F.coalesce(F.col(text), F.lit("")))})
    lines = named.select(F.col(doc).alias("d"), F.col(tag).alias("t"), F.col(host).alias("host"), F.col(id_col).alias("id"),
                         F.posexplode(F.transform(lines_of(F.col(text)), line_key)).alias("pos", "key"))
    hits = (lines.where(F.col("key") != "")
            .select("d", "t", "id", "pos", F.length(F.translate("key", SPACE_CHARS, "")).alias("chars"),
                    F.xxhash64("host", "key").alias("a"), F.xxhash64(F.lit(1), "host", "key").alias("b"))
            .join(maybe_broadcast(frequent, BROADCAST_ROWS), ["a", "b"])
            .where(~F.col("id").eqNullSafe(F.col("first")))
            .dropDuplicates(["d", "t", "pos"])
            .groupBy("d", "t").agg(F.sum("chars").alias("boiler_chars"))
            .withColumnsRenamed({"d": doc, "t": tag}))
    stats = text_stats(named.drop("boiler_chars", "base_failed", "kept"), text)
    left = F.col("word_chars") - F.col("boiler_chars")
    return (stats.join(hits, [doc, tag], "left").drop(doc, tag)
            .withColumn("boiler_chars", F.coalesce("boiler_chars", F.lit(0)).cast("long"))
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed")
                        & ((F.col("boiler_chars") == 0) | (left >= min_left * F.col("word_chars")))))
