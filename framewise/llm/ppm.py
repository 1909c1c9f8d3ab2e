"""Language-model scores by prediction by partial matching (PPM).

A text is its tokens (words, A-Z in lower case) with one space between and an
end mark.  Training counts every byte with the ``ORDER`` bytes before it; the
counts of shorter contexts are sums of these, so the byte-context trie is one
table (context and byte, count) built with map-side sums.  Scoring codes each
byte in the longest known context: probability c / (C + q) for a byte seen c
of C times among q distinct bytes, else the escape q / (C + q) to the context
one byte shorter, where the bytes that the longer context has seen are
excluded; below order 0 the bytes left are equally likely.  A text's score is
the log10 of the product over its bytes and end mark.

The trie is broadcast in shards of at most ``MAX_NODES`` rows.  A byte's
contexts of two bytes and more end in the same two bytes, so shards are cut by
those; each shard scores the positions that are its own and the parts add up.
One shard is the usual case, more cost a pass each; nothing is left out.

The base score is an add-one unigram model over tokens.  Tokens with at least
N / ``HEAD`` of all N occurrences (at most ``HEAD`` of them, whatever the
data) are looked up from a broadcast table, all others by a join on the
token's hash, where no key holds more than N / ``HEAD`` rows.

Defined results.  Null or empty text: the end mark alone.  Null id: its crc32
counts as 0, so it trains.  Repeated rows: each is scored and each counts.
No training rows: every token unknown, bytes equally likely.  Empty table:
empty result.  Columns other than id and text are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import bounded_batches, byte_codes, flat, signed, utf8, word_hashes, write_scratch

ORDER = 5
#: Rows of one trie shard (16 bytes each, 64 MB).
MAX_NODES = 4_000_000
#: Bound on the tokens whose counts are broadcast (16 bytes each, 8 MB).
HEAD = 500_000
#: Distinct keys a counting task holds before it passes them on.
HOLD = 1_000_000
END, SPACE = 0x0A, 0x20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def streams(data: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray):
    """Code of every byte with the ORDER bytes before it (the byte itself in
    the low 8 bits, end marks before a text's start), and the index of each
    text's first code."""
    texts, words = len(first) - 1, np.diff(first)
    sizes = e - s + 1  # a word and what follows it
    total = np.concatenate([[0], np.cumsum(sizes)])
    body = total[first[1:]] - total[first[:-1]] + (words == 0)
    begins = np.concatenate([[0], np.cumsum(body + ORDER)])
    out = np.full(int(begins[-1]), END, np.uint8)
    doc = np.repeat(np.arange(texts), words)
    at = begins[doc] + ORDER + total[:-1] - total[first[doc]]  # where each word goes
    lengths = e - s
    shift = np.repeat(at - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(s) else s, lengths)
    source = np.repeat(s - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(s) else s, lengths)
    every = np.arange(int(lengths.sum()))
    out[every + shift] = _LOWER[data[every + source]]
    gaps = np.ones(len(s), bool)
    gaps[first[1:][words > 0] - 1] = False
    out[(at + lengths)[gaps]] = SPACE
    code = out.astype(np.uint64)
    for k in range(1, ORDER + 1):
        code[k:] |= out[:-k].astype(np.uint64) << np.uint64(8 * k)
    own = np.ones(len(out), bool)
    for k in range(ORDER):
        own[begins[:-1] + k] = False
    return code[own], np.concatenate([[0], np.cumsum(body)])


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, ascending, with the sum of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


_WORD, _NODE, _ENDS = 0, 1, 2


def _count(batches):
    codes = byte_codes("space", True)
    held: dict[int, list] = {_WORD: [], _NODE: []}
    ends = 0

    def merged(kind):
        parts = held[kind]
        keys, n = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return keys, n

    def rows(kind, keys, n):
        for i in range(0, len(keys), 100_000):
            part = keys[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int32)), pa.array(signed(part)),
                 pa.array(n[i:i + 100_000].astype(np.int64))], names=["kind", "key", "n"])

    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, s, e, first = word_hashes(data, offsets, codes)
        code, _ = streams(data, s, e, first)
        ends += batch.num_rows
        for kind, keys in ((_WORD, h), (_NODE, code)):
            held[kind].append(np.unique(keys, return_counts=True))
            if sum(len(p[0]) for p in held[kind]) > HOLD:
                held[kind] = [merged(kind)]
                if len(held[kind][0][0]) > HOLD // 2:
                    yield from rows(kind, *held[kind][0])
                    held[kind] = []
    for kind, parts in held.items():
        if parts:
            yield from rows(kind, *merged(kind))
    if ends:
        yield from rows(_ENDS, np.zeros(1, np.uint64), np.array([ends]))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A written table (kind, key, n): token counts, trie counts, end marks of
    the rows of ``docs`` that are not held out."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(~held_out(F.col(id_col))).select(F.col(text).alias("text"))
    counted = rows.mapInArrow(_count, "kind int, key long, n long")
    return write_scratch(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ppm-counts")


class Trie:
    """Contexts of one shard.  Per order k, ascending: ``code`` (context and
    byte) with ``n``; ``ctx`` with total ``c``, distinct bytes ``q`` and
    ``below``, the total that its bytes have in the context one byte shorter."""

    def __init__(self, code: np.ndarray, n: np.ndarray, short: np.ndarray, short_n: np.ndarray) -> None:
        """``code``, ``n``: counts of order ORDER; ``short``: those of order 1
        over the whole corpus."""
        self.levels = []
        for k in range(ORDER + 1):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            own, count = summed(short & mask, short_n) if k < 2 else summed(code & mask, n)
            ctx = own >> np.uint64(8)
            begin = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])) if len(ctx) else np.zeros(0, np.int64)
            q = np.diff(np.append(begin, len(ctx)))
            c = np.add.reduceat(count, begin) if len(begin) else count
            below = np.zeros(len(begin), np.int64)
            if k and len(begin):
                up = self.levels[-1]
                lower = own & np.uint64((1 << (8 * k)) - 1)
                below = np.add.reduceat(up["n"][np.searchsorted(up["code"], lower)].astype(np.int64), begin)
            self.levels.append({"code": own, "n": small(count), "ctx": ctx[begin], "c": small(c), "q": small(q),
                                "below": small(below)})

    def log10p(self, code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code))
        todo = np.arange(len(code))
        used = np.zeros(len(code), np.int64)  # distinct bytes excluded
        taken = np.zeros(len(code), np.int64)  # their total at the next level
        for k in range(ORDER, -1, -1):
            if not len(todo):
                return out
            level = self.levels[k]
            own = code[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            i, known = found(level["ctx"], own >> np.uint64(8))
            j, seen = found(level["code"], own)
            if len(level["ctx"]):
                c = level["c"][i].astype(np.int64) - taken[todo]
                q = level["q"][i].astype(np.int64) - used[todo]
                n = np.where(seen, level["n"][j].astype(np.int64), q)
                cost = known & (seen | (q > 0))
                out[todo[cost]] += np.log10(n[cost] / (c + q)[cost])
                used[todo] = np.where(known, level["q"][i], used[todo])
                taken[todo] = np.where(known, level["below"][i], 0)
            todo = todo[~seen]
        out[todo] -= np.log10(256 - used[todo])
        return out


def small(n: np.ndarray) -> np.ndarray:
    """The numbers in the narrowest unsigned type that holds them."""
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each key in the ascending table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def shard_of(code, shards: int):
    """Shard of a code, by the two bytes before its own."""
    two = (code >> np.uint64(8)) & np.uint64(0xFFFF)
    return (two * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(shards)


_SCORED = ("id long, row long, held_out boolean, n_tokens long, head_known long, head_sum double, "
           "score double, tail array<long>")


def _score(batches, trie, head, shard: int, shards: int):
    codes = byte_codes("space", True)
    keys, counts = head.value
    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, s, e, first = word_hashes(data, offsets, codes)
        code, begin = streams(data, s, e, first)
        part = np.zeros(len(code) + 1)
        for i in range(0, len(code), 1 << 20):
            some, back = np.unique(code[i:i + (1 << 20)], return_inverse=True)
            p = trie.value.log10p(some)
            if shards > 1:
                p[shard_of(some, shards) != shard] = 0
            part[i + 1:i + 1 + len(back)] = p[back]
        score = np.add.reduceat(part[1:], begin[:-1]) if len(begin) > 1 else np.zeros(0)
        if shard:
            yield pa.RecordBatch.from_arrays([flat(batch, "row"), pa.array(score)], names=["row", "score"])
            continue
        at, known = found(keys, h)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
        logs = np.where(known, np.log10(counts[at] + 1.0) if len(keys) else 0.0, 0.0)
        tail = np.bincount(doc[~known], minlength=batch.num_rows)
        ends = np.concatenate([[0], np.cumsum(tail)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [flat(batch, "id"), flat(batch, "row"), flat(batch, "held_out"), pa.array(np.diff(first).astype(np.int64) + 1),
             pa.array(np.bincount(doc[known], minlength=batch.num_rows).astype(np.int64)),
             pa.array(np.bincount(doc, logs, batch.num_rows).astype(float)), pa.array(score),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(h[~known])))],
            names=["id", "row", "held_out", "n_tokens", "head_known", "head_sum", "score", "tail"])


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(c).combine_chunks().to_numpy() if len(table) else np.zeros(0, np.int64) for c in names]


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    counts = train(docs, id_col, text)
    totals = {r.kind: (r.n, r.v) for r in counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    ends = totals.get(_ENDS, (0, 0))[0]
    n, v = totals.get(_WORD, (0, 0))[0] + ends, totals.get(_WORD, (0, 0))[1] + bool(ends)
    words = counts.where(F.col("kind") == _WORD).select("key", "n")
    many = F.col("n") * HEAD >= n
    key, c = _columns(words.where(many), "key", "n")
    key = key.view(np.uint64)
    order = np.argsort(key)
    head = spark.sparkContext.broadcast((key[order], c[order]))

    nodes = counts.where(F.col("kind") == _NODE).select("key", "n")
    shards = max(1, math.ceil(totals.get(_NODE, (0, 0))[1] / MAX_NODES))
    short = [x.astype(t) for x, t in zip(_columns(
        nodes.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key")).agg(F.sum("n").alias("n")),
        "key", "n"), (np.uint64, np.int64), strict=True)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    if shards > 1:  # all shards must see the same row numbers
        rows = write_scratch(rows, "ppm-rows")
    two = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit(0xFFFF))
    whole = None
    for shard in range(shards):
        mine = nodes if shards == 1 else nodes.where(
            F.shiftrightunsigned(two * 2654435761, 7) % shards == shard)
        code, c = _columns(mine, "key", "n")
        trie = spark.sparkContext.broadcast(Trie(code.view(np.uint64), c, *short))
        if not shard:
            whole = write_scratch(rows.mapInArrow(
                lambda it, t=trie: _score(it, t, head, 0, shards), _SCORED), "ppm-scored")
        else:
            part = rows.mapInArrow(lambda it, t=trie, k=shard: _score(it, t, head, k, shards),
                                   "row long, score double")
            whole = write_scratch(
                whole.join(part.withColumnRenamed("score", "more"), "row")
                .withColumn("score", F.col("score") + F.col("more")).drop("more"), "ppm-scored")

    pairs = whole.select("row", F.explode("tail").alias("key"))
    rest = words.where(~many)
    known = (pairs.join(rest, "key").groupBy("row").agg(
        F.count("*").alias("tail_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("tail_sum")))
    out = whole.drop("tail").join(known, "row", "left")
    end_log = math.log10(ends + 1)
    return out.select(
        "id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + end_log
         - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score")
