"""Prefix trie of conversations by union-find over sorted neighbours.

Conversations, each a sequence of turn keys, are range-sorted by that sequence
(ties by id, so copies of one conversation spread over many tasks).  A node of
the trie is a maximal stretch of sorted conversations whose neighbours share
their first d turns.  Each task cuts its sorted slice into runs of bounded
size and builds the forest of a run from the edges between neighbours, taken
by their longest common prefix in descending order: the union of two
components at depth d makes the branching node of depth d, and the turns
between it and the components' tops are chains of nodes with one child.

Only nodes on the path of a run's first or last conversation can go on in
another run.  All others are whole and leave the task with their results;
those of the two paths are the contracted forest, at most twice a
conversation's length a run.  Open nodes are merged across the boundaries by
the digest of their turns, and since a subtree is a contiguous stretch of the
sorted order, sums over subtrees are differences of one running total.

A conversation is one row (as a text is one value); no group of conversations
ever is: equal ones are merged where they are sorted, and the ids that end at
an open node are digested from a sorted stream.

Defined results.  Null role or text: empty.  Turns in order of turn, null
first, ties by a digest of role and text.  Null conversation: its rows are one
conversation without a shared head, first among the ids and called ``null``.
Ids are cast to long.  Repeated rows: repeated turns.  Empty table: empty
result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import bounded_batches, flat, keep_scratch, maybe_broadcast, write_scratch
from framewise.operators.windows import prefix_sum
from framewise.session import scratch_written

#: Conversations and bytes of one run.
RUN_ROWS, RUN_BYTES = 20_000, 4 << 20
#: Open nodes (id and conversation, 24 bytes) up to which they are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000
WORD = r"[^\x20\x09-\x0D]+"

_NODES = ("run long, spot_first long, spot_last long, id binary, parent binary, open boolean, depth long, "
          "conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "words long, ends string, ends_sha256 string")


# ---------------------------------------------------------------- conversations

def turn_key(role: Column, text: Column) -> Column:
    """128 bits that name a turn's role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turns): the (key, words) of a conversation's turns, in order."""
    one = F.struct(F.col(turn).cast("long").alias("turn"), turn_key(F.col(role), F.col(text)).alias("key"),
                   F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("words"))
    return rows.select(F.col(conv).cast("long").alias("conv_id"), one.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["key"], t["words"])).alias("turns"))


def rebuilt(convs: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Conversations c whose first h turns are those of conversation c - c %
    ``every``, h = crc32(c) % ``heads``."""
    c = F.col("conv_id")
    base = convs.where(c % every == 0).select(
        c.alias("base"), F.slice("turns", 1, heads - 1).alias("head")) if heads > 1 else None
    h = F.coalesce(F.crc32(c.cast("string")) % heads, F.lit(0)).cast("int")
    if base is None:
        return convs
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.slice(F.coalesce("head", F.array().cast(convs.schema["turns"].dataType)), F.lit(1), h)
    return convs.join(base, c - c % every == F.col("base"), "left").select(
        "conv_id", F.concat(head, own).alias("turns"))


# ---------------------------------------------------------------- forest of a run

def _common(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Turns that each conversation shares with the one before (0 for the first)."""
    size = np.diff(first)
    out = np.zeros(len(size), np.int64)
    live = np.arange(1, len(size))
    depth = 0
    while len(live):
        live = live[(size[live] > depth) & (size[live - 1] > depth)]
        same = (keys[first[live] + depth] == keys[first[live - 1] + depth]).all(1)
        live = live[same]
        depth += 1
        out[live] = depth
    return out


class _Forest:
    """Trie nodes of sorted conversations, by union-find."""

    def __init__(self, sizes: np.ndarray, common: np.ndarray) -> None:
        n = len(sizes)
        self.depth = sizes.tolist()  # node i: where conversation i ends
        self.low, self.high = list(range(n)), list(range(n))
        self.parent, self.is_ = [-1] * n, list(range(n))  # is_: nodes found to be the same one
        self._up, self._top = list(range(n)), list(range(n))  # of components of conversations
        for i in (np.argsort(-common[1:], kind="stable") + 1).tolist():
            self._union(i - 1, i, int(common[i]))
        self._chain(self._top[self._find(self._up, 0)], 0)

    @staticmethod
    def _find(up: list[int], i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def node_of(self, i: int) -> int:
        return self._find(self.is_, i)

    def _node(self, depth: int, low: int, high: int) -> int:
        self.is_.append(len(self.depth))
        for column, value in ((self.depth, depth), (self.low, low), (self.high, high), (self.parent, -1)):
            column.append(value)
        return len(self.depth) - 1

    def _chain(self, node: int, depth: int) -> int:
        """The node of ``depth`` above ``node``, through nodes of one child."""
        while self.depth[node] > depth:
            self.parent[node] = self._node(self.depth[node] - 1, self.low[node], self.high[node])
            node = self.parent[node]
        return node

    def _union(self, i: int, j: int, depth: int) -> None:
        a, b = self._find(self._up, i), self._find(self._up, j)
        left, right = self._top[a], self._top[b]
        low, high = self.low[left], self.high[right]
        tops = [t for t in (left, right) if self.depth[t] == depth]
        top = tops[0] if tops else self._node(depth, low, high)
        for t in (left, right):
            if self.depth[t] > depth:
                self.parent[self._chain(t, depth + 1)] = top
            else:
                self.is_[t] = top
        self.low[top], self.high[top] = low, high
        self._up[b], self._top[a] = a, top


def _path(keys: np.ndarray, first: np.ndarray, i: int) -> list[bytes]:
    """Digest of every prefix of conversation i."""
    out = [bytes(16)]
    for key in keys[first[i]:first[i + 1]]:
        out.append(hashlib.blake2b(out[-1] + key.tobytes(), digest_size=16).digest())
    return out


def _run(batch: pa.RecordBatch, run: int) -> pa.RecordBatch:
    """All nodes of a run: whole ones with their results, open ones with the
    sums over what hangs whole below them."""
    ids = flat(batch, "conv_id").to_pylist()
    first = np.append(0, np.cumsum(pc.list_value_length(flat(batch, "words")).to_numpy()))
    raw = b"".join(pc.list_flatten(flat(batch, "keys")).to_pylist())
    keys = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    words = pc.list_flatten(flat(batch, "words")).to_pylist()
    f = _Forest(np.diff(first), _common(keys, first))
    last = len(ids) - 1
    paths = _path(keys, first, 0), _path(keys, first, last)
    count = len(f.depth)
    ends: list[list] = [[] for _ in range(count)]
    for i, c in enumerate(ids):
        ends[f.node_of(i)].append(c)
    kids, leaves, saved, least = [0] * count, [0] * count, [0] * count, [None] * count
    rows = []
    for v in sorted((v for v in range(count) if f.is_[v] == v), key=lambda v: -f.depth[v]):
        low, high, depth = f.low[v], f.high[v], f.depth[v]
        own = [least[v], *ends[v]]
        least[v] = min((c for c in own if c is not None), default=None)
        is_open = low == 0 or high == last
        size = words[first[low] + depth - 1] if depth else 0
        if not is_open:
            leaves[v] = leaves[v] or 1
            saved[v] += (high - low) * size
        up = f.node_of(f.parent[v]) if depth else -1
        if depth:
            if least[v] is not None:
                least[up] = least[v] if least[up] is None else min(least[up], least[v])
            if not is_open:
                kids[up] += 1
                leaves[up] += leaves[v]
                saved[up] += saved[v]
        rows.append((v, up, is_open, size))
    out: dict[str, list] = {c.split()[0]: [] for c in _NODES.split(", ")}
    for v, up, is_open, size in rows:
        low, high, depth = f.low[v], f.high[v], f.depth[v]
        text = ",".join("null" if c is None else str(c) for c in ends[v])
        up_open = up >= 0 and (f.low[up] == 0 or f.high[up] == last)
        side = 0 if low == 0 else 1
        for c, value in zip(out, (
                run, 2 * run + side, 2 * run + (1 if high == last else 0),
                paths[side][depth] if is_open else None,
                paths[0 if f.low[up] == 0 else 1][depth - 1] if up_open else None,
                is_open, depth, least[v], None if up < 0 or up_open else least[up], high - low + 1,
                kids[v], leaves[v], saved[v], size, text if is_open and ends[v] else None,
                None if is_open else hashlib.sha256(text.encode()).hexdigest()), strict=True):
            out[c].append(value)
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.RecordBatch.from_pydict({k: pa.array(x, kinds[c.split()[1]])
                                       for c, (k, x) in zip(_NODES.split(", "), out.items(), strict=True)})


def _forests(batches: Iterator[pa.RecordBatch], run_rows: int) -> Iterator[pa.RecordBatch]:
    """The runs of one sorted slice, numbered in the order of all slices."""
    run = TaskContext.get().partitionId() << 32
    held, rows, size = [], 0, 0
    for b in batches:
        if b.num_rows:
            held, rows, size = [*held, b], rows + b.num_rows, size + b.nbytes
        while rows >= run_rows or size >= RUN_BYTES:
            all_rows = pa.concat_batches(held)
            yield _run(all_rows.slice(0, run_rows), run)
            rest = all_rows.slice(run_rows)
            held, rows, size, run = [rest] if rest.num_rows else [], rest.num_rows, 0, run + 1
    if held:
        yield _run(pa.concat_batches(held), run)


# ---------------------------------------------------------------- merging across boundaries

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ends_sha256) of pieces of text sorted by (id, run), as they come."""
    now, state = None, None

    def done():
        return pa.RecordBatch.from_pydict({"id": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})

    for b in batches:
        for key, text in zip(flat(b, "id").to_pylist(), flat(b, "ends").to_pylist(), strict=True):
            if key != now:
                if state is not None:
                    yield done()
                now, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield done()


def _subtree(nodes: DataFrame, weight: str) -> DataFrame:
    """(id, ``weight``): sums over the subtrees of open nodes.  By (first spot,
    depth) a subtree is the stretch from its top to its last spot's end."""
    far = 1 << 62
    stops = nodes.select(F.col("spot_last").alias("spot")).distinct().select(
        F.lit(None).cast("binary").alias("id"), "spot", F.lit(far).alias("depth"), F.lit(0).cast("long").alias("w"))
    tops = nodes.select("id", F.col("spot_first").alias("spot"), "depth", F.col(weight).cast("long").alias("w"))
    summed = prefix_sum(tops.unionByName(stops), ["spot", "depth"], "w", "s")
    end = summed.where(F.col("depth") == far).select(F.col("spot").alias("spot_last"), F.col("s").alias("e"))
    return (nodes.select("id", "spot_last").join(summed.where(F.col("depth") < far), "id").join(end, "spot_last")
            .select("id", (F.col("e") - F.col("s") + F.col("w")).alias(weight)))


def _merged(rows: DataFrame) -> DataFrame:
    """Open nodes put together over all runs, with their results."""
    n = rows.where("open").groupBy("id").agg(
        F.min("spot_first").alias("spot_first"), F.max("spot_last").alias("spot_last"),
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.first("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    n = write_scratch(n, "trie-open")
    kids = n.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("kids"))
    n = n.join(kids, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    n = write_scratch(n.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")}).drop("kids"), "trie-open")
    ends = rows.where(F.col("ends").isNotNull()).select("id", "run", "ends")
    ends = ends.repartition("id").sortWithinPartitions("id", "run").select("id", "ends").mapInArrow(
        _digests, "id binary, ends_sha256 string")
    whole = n.drop("n_leaves", "saved_tokens").join(ends, "id", "left")
    for c in ("n_leaves", "saved_tokens"):
        whole = whole.join(_subtree(n, c), "id")
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def trie_of(convs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """All nodes of the trie of (conv_id, turns): (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``n_convs`` conversations start with the node's turns, ``conv_id`` is the
    smallest of them; ``saved_tokens`` are the words that the node's subtree
    stores once for several conversations."""
    spark = convs.sparkSession
    bounded_batches(spark)
    mark = scratch_written(spark)
    keys = F.transform("turns", lambda t: t["key"])
    path = convs.select("conv_id", keys.alias("keys"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = write_scratch(path.orderBy("keys", "conv_id").mapInArrow(
        lambda batches: _forests(batches, run_rows), _NODES), "trie-nodes")
    opened = write_scratch(_merged(rows), "trie-merged")
    results = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    nodes = rows.where(~F.col("open")).select(*results, "parent", "parent_conv_id").unionByName(
        opened.select(*results, "parent", F.lit(None).cast("long").alias("parent_conv_id")))
    above = maybe_broadcast(opened.select(F.col("id").alias("parent"), F.col("conv_id").alias("above")),
                            BROADCAST_ROWS)
    out = nodes.join(above, "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        *results[2:])
    out = write_scratch(out, "trie")
    keep_scratch(spark, mark, out)
    return out
