"""Benchmark decontamination with a generalised suffix automaton.

The normalised items (words as numbers) go into one suffix automaton.  The
words of a document are streamed through it; the state keeps the longest
match that ends at each word.  Where the match is at least ``window`` words
long, the last ``window`` words are a window of some item and are *hit*; an
item shorter than the window counts when all of it matches.

Items are a stated query set, read in blocks of at most ``BLOCK_WORDS`` words:
one automaton per block is broadcast (its size is bounded by the block), and
the documents are scanned once per block, with the result written between.  An
item longer than a block is cut into parts that overlap by a window less one
word, so that every window lies in one part.
The automaton only runs over stretches whose neighbouring word pairs all
occur in items; everything else cannot hold a window and is passed over with
array operations.

Defined results.  Null or empty text: no words, not contaminated.  Items
without words match nothing.  Repeated items (same id or same text) all count,
by their distinct ids; a null id is the text "null".  Empty tables: nothing is
hit.  Input columns pass through; result columns replace equal names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.common import (bounded_batches, byte_codes, flat, utf8, word_hashes,
                                  write_scratch)

WINDOW = 13
#: Words of items in one automaton: bounds the broadcast to about 100 MB.
BLOCK_WORDS = 200_000
#: A document is contaminated when so many times its hit words reach its words.
COVERAGE = 20


class Automaton:
    """Generalised suffix automaton over number sequences.

    ``full[v]``: items having a full window that ends in state v; asked for
    at the state whose strings include the one of ``window`` words.
    ``whole[v]``: (length, item) of the short items spelt by state v."""

    def __init__(self, sequences: list[tuple[str, list[int]]], window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[str]] = {}
        self.whole: dict[int, set[tuple[int, str]]] = {}
        for _, words in sequences:
            last = 0
            for w in words:
                last = self._extend(last, w)
        for item, words in sequences:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= window:
                    ends.setdefault(self._of_length(state, window), set()).add(item)
            if 0 < len(words) < window:
                self.whole.setdefault(self._of_length(state, len(words)), set()).add((len(words), item))
        self.full = ends
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        #: nearest state on the suffix path, itself included, that spells a short item
        self.short = [-1] * len(order)
        for v in order:
            up = self.link[v]
            self.short[v] = v if v in self.whole else (self.short[up] if up >= 0 else -1)

    def _of_length(self, state: int, n: int) -> int:
        """The state that holds the suffix of n words of ``state``'s strings."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state({}, length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p == -1:
            link[new] = 0
        else:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, edges: dict[int, int], n: int) -> int:
        self.next.append(edges)
        self.length.append(n)
        self.link.append(-1)
        return len(self.length) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[c], self.link[q] = self.link[q], c
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def scan(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(end, length, items) of every occurrence of a window in ``words``."""
        state, n = 0, 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w not in self.next[state]:
                n = 0
                continue
            state, n = self.next[state][w], n + 1
            at = state
            if n >= self.window:
                at = self._of_length(state, self.window)
                yield i + 1, self.window, self.full.get(at, set())
            # short items: the state's own strings reach from its link's length + 1 to n words
            v = self.short[at]
            while v != -1:
                for size, item in self.whole[v]:
                    if size <= n:
                        yield i + 1, size, {item}
                up = self.link[v]
                v = self.short[up] if up >= 0 else -1


class Items:
    """A block of items ready for scanning: vocabulary, word pairs, automaton."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        items = [(i, h) for i, h in items if len(h)]
        self.shortest = min((min(len(h), window) for _, h in items), default=0)
        every = np.concatenate([h for _, h in items]) if items else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(every)
        numbered = [(i, np.searchsorted(self.vocabulary, h)) for i, h in items]
        pairs = [a[:-1] * len(self.vocabulary) + a[1:] for _, a in numbered]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.automaton = Automaton([(i, a.tolist()) for i, a in numbered], window)

    def hits(self, h: np.ndarray, first: np.ndarray):
        """Per text: spans (start, end in words) and ids of the items hit."""
        spans: list[list[tuple[int, int]]] = [[] for _ in range(len(first) - 1)]
        found: list[set[str]] = [set() for _ in range(len(first) - 1)]
        if not self.shortest or not len(h):
            return spans, found
        at = np.searchsorted(self.vocabulary, h)
        at[at == len(self.vocabulary)] = 0
        number = np.where(self.vocabulary[at] == h, at, -1)
        linked = np.zeros(len(h) + 1, bool)  # word i and the one before are a pair of some item
        if len(self.pairs):
            known = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
            pair = number[known] * len(self.vocabulary) + number[known + 1]
            near = np.searchsorted(self.pairs, pair)
            near[near == len(self.pairs)] = 0
            linked[known[self.pairs[near] == pair] + 1] = True
        linked[first] = False
        starts = np.flatnonzero(~linked[:-1])
        ends = np.append(starts[1:], len(h))
        long = (ends - starts >= self.shortest) & (number[starts] >= 0)
        doc = np.searchsorted(first, starts, side="right") - 1
        for s, e, d in zip(starts[long].tolist(), ends[long].tolist(), doc[long].tolist(), strict=True):
            base = s - int(first[d])
            for end, size, items in self.automaton.scan(number[s:e].tolist()):
                a, b = base + end - size, base + end
                own = spans[d]
                while own and own[-1][1] >= a:  # hits come in order of their ends
                    a = min(a, own.pop()[0])
                own.append((a, b))
                found[d] |= items
        return spans, found


def _item_blocks(benchmark: DataFrame, id_col: str, text: str, window: int) -> Iterator[Items]:
    """Items in blocks of bounded size, streamed from Spark."""
    codes, block, size = byte_codes("alnum", True), [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"),
                            F.coalesce(F.col(text), F.lit("")).alias("t"))
    for row in rows.toLocalIterator():
        data, offsets = utf8(pa.array([row.t]))
        whole = word_hashes(data, offsets, codes)[0]
        most = max(BLOCK_WORDS, window)
        for k in range(0, max(1, len(whole) - window + 1), most - window + 1):
            h = whole[k:k + most]
            if block and size + len(h) > BLOCK_WORDS:
                yield Items(block, window)
                block, size = [], 0
            block.append((row.i, h))
            size += len(h)
    if block:
        yield Items(block, window)


_NEW = {"n_words": T.LongType(), "hit_spans": T.ArrayType(T.ArrayType(T.IntegerType())),
        "hit_items": T.ArrayType(T.StringType())}


def _scan(batches, items, text: str, again: bool, keep_text: bool, max_span: int | None):
    codes = byte_codes("alnum", True)
    spans_type, ids_type = pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())
    for batch in batches:
        data, offsets = utf8(flat(batch, text))
        h, _, _, first = word_hashes(data, offsets, codes)
        spans, found = items.value.hits(h, first)
        if again:
            before = zip(flat(batch, "hit_spans").to_pylist(), flat(batch, "hit_items").to_pylist(), strict=True)
            for d, (s, f) in enumerate(before):
                spans[d] = merged(spans[d] + [tuple(x) for x in s])
                found[d] |= set(f)
        rest = {f: flat(batch, f) for f in batch.schema.names if f not in _NEW and (keep_text or f != text)}
        if keep_text and max_span is not None:
            rest[text] = _without(rest[text], {d: some for d, own in enumerate(spans) if (
                some := [x for x in own if x[1] - x[0] > max_span])})
        yield pa.RecordBatch.from_arrays(
            [*rest.values(), pa.array(np.diff(first).astype(np.int64)),
             pa.array([[list(x) for x in s] for s in spans], spans_type),
             pa.array([sorted(f) for f in found], ids_type)], names=[*rest, *_NEW])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
              item_text: str = "text", window: int = WINDOW, keep_text: bool = True,
              max_span: int | None = None) -> DataFrame:
    """``docs`` (without the text, if that is not kept) with ``n_words``, ``hit_spans`` (merged [start, end) in words),
    ``hit_items`` (distinct ids, sorted), ``n_hit`` and ``contaminated``.  With
    ``max_span`` the texts lose hit spans of more words in the same pass."""
    spark = docs.sparkSession
    bounded_batches(spark)
    out = docs.drop(*_NEW, "n_hit", "contaminated")
    rest = list(out.schema.fields)
    schema = T.StructType(rest + [T.StructField(c, k) for c, k in _NEW.items()])
    blocks = _item_blocks(benchmark, item_id, item_text, window)
    block, again = next(blocks, Items([], window)), False
    while block is not None:
        following = next(blocks, None)
        if again:
            out = write_scratch(out, "decontam-block")
        keep = keep_text or following is not None
        shared = spark.sparkContext.broadcast(block)
        cut = max_span if following is None else None
        out = out.mapInArrow(lambda it, b=shared, a=again, k=keep, c=cut: _scan(it, b, text, a, k, c),
                             T.StructType([f for f in schema.fields if keep or f.name != text]))
        block, again = following, True
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"),
                        lambda n, s: n + (F.get(s, F.lit(1)) - F.get(s, F.lit(0))))
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", is_contaminated())


def is_contaminated(coverage: int = COVERAGE) -> Column:
    return (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))


def _without(column: pa.Array, cuts: dict[int, list[tuple[int, int]]]) -> pa.Array:
    """The texts without the spans of words that ``cuts`` has by row."""
    if not cuts:
        return column
    data, offsets = utf8(column.take(pa.array(list(cuts), pa.int64())))
    _, s, e, first = word_hashes(data, offsets, byte_codes("alnum", True))
    texts = column.to_pylist()
    for k, (d, spans) in enumerate(cuts.items()):
        raw, at, parts = data[offsets[k]:offsets[k + 1]].tobytes(), 0, []
        for a, b in spans:
            parts.append(raw[at:int(s[first[k] + a] - offsets[k])])
            at = int(e[first[k] + b - 1] - offsets[k])
        texts[d] = b"".join([*parts, raw[at:]]).decode()
    return pa.array(texts, column.type)


def _cut(batches, text: str, max_span: int, coverage: int | None):
    for batch in batches:
        cuts = {}
        rows = zip(*(flat(batch, c).to_pylist() for c in ("hit_spans", "n_hit", "n_words")), strict=True)
        for d, (spans, hit, words) in enumerate(rows):
            over = coverage is not None and hit and coverage * hit >= words
            if some := [x for x in spans if over or x[1] - x[0] > max_span]:
                cuts[d] = some
        i = batch.schema.get_field_index(text)
        yield batch.set_column(i, batch.schema.field(i), _without(batch.column(i), cuts))


def remove_spans(hits: DataFrame, text: str = "text", max_span: int = 0, coverage: int | None = None) -> DataFrame:
    """Cut hit spans of more than ``max_span`` words out of the texts of
    ``find_hits``' result; documents of which a ``coverage``-th or more is hit
    lose all their hit spans.  What stands between spans stays as it is."""
    bounded_batches(hits.sparkSession)
    return hits.mapInArrow(lambda it: _cut(it, text, max_span, coverage), hits.schema)
