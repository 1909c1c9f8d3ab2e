"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source, its documents in pseudorandom order, are packed into
blocks of ``block`` words (the last may be shorter).  The mix is a list of
slots, dealt into output shards; each slot takes one block:

1. A source's target is its weight's share of all words, no more than
   ``most`` times its own; what is above is shared again by weight.  In the
   order of size by weight the sources held at that bound come first, so two
   running totals over the sources tell which they are.
2. A source's quota is its target in blocks.  For each shard the number of
   slots of every source is a multinomial draw with the quotas as weights
   (sources in groups of 4,096: first the groups, then inside them), seeded by
   the shard, so a shard is drawn the same way whichever task does it.
3. Multinomial counts miss the quotas by about their square roots and could
   take a block once more than ``most`` times.  The slots that a source drew
   beyond its quota go, numbered, to the sources that drew too few.
4. The q-th slot of a source is pass q div n, position q mod n over its n
   blocks; a keyed Feistel permutation of 0..n-1 for each source and pass
   gives the block, so every pass takes each block once.
5. Blocks are joined with slots by (source, block).

Sources are tables like any other: a hot source is range-sorted, its blocks
spread over all tasks, and only scalars and one number per 4,096 sources reach
the driver.

Defined results.  Null or empty text: size 0, never taken.  Null source: a
source of its own, last.  Null or repeated ids, repeated rows: every row is a
document.  No words at all: targets 0, nothing taken.  Empty table: empty
result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import bounded_batches, flat, maybe_broadcast, mix as mixed_bits, write_scratch
from framewise.operators.keys import join_on
from framewise.operators.windows import prefix_sum, row_number_global

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block; slots of an output shard.
BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 16
WEIGHTS = (5, 2, 1)
_ROUNDS = mixed_bits(np.arange(1, 5, dtype=np.uint64))
#: Sources whose counts are drawn together, and groups of them (64 KB each) up to which they are broadcast.
GROUP = 4096
BROADCAST_GROUPS = 1000


class Mix(NamedTuple):
    """``docs``: doc_id, source, tag, size, number, first (word of the source
    where the document starts).  ``sources``: number, source, source_size,
    weight, target, blocks, quota.  ``spans``: shard, slot, number, block,
    part, first, start, stop: the words [start, stop) of a document."""

    docs: DataFrame
    sources: DataFrame
    spans: DataFrame


def source_targets(docs: DataFrame, weights: Sequence[int], most: int, block: int) -> DataFrame:
    """The sources of (source, size) rows with weights, targets and quotas."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = row_number_global(sizes, [F.col("source").asc_nulls_last()], name="number")
    common = math.lcm(*weights)
    ratio = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1)
                         .cast("int")).cast("long")
    s = write_scratch(s.withColumn("weight", ratio).withColumn("bound", most * F.col("source_size"))
                      .withColumn("rank", F.col("bound") * F.expr(f"{common} div weight")), "mix-sources")
    order = ["rank", "number"]
    upto = prefix_sum(s, order, "bound", "bound_to").join(
        prefix_sum(s, order, "weight", "weight_to").select("number", "weight_to"), "number")
    whole = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t"),
                  F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    exact = lambda c: c.cast("decimal(19,0)")
    held = (exact(F.lit(whole.t) - F.col("bound_to") + F.col("bound")) * exact(F.col("weight")) >
            exact(F.col("bound")) * exact(F.lit(whole.w) - F.col("weight_to") + F.col("weight")))
    upto = write_scratch(upto.withColumn("held", held), "mix-sources")
    taken = upto.where("held").agg(F.coalesce(F.sum("bound"), F.lit(0)).alias("t"),
                                   F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    left = whole.w - taken.w
    target = F.when(F.col("held"), F.col("bound").cast("double")).otherwise(
        F.lit(float(whole.t - taken.t)) * F.col("weight") / F.lit(left or 1))
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    quota = F.when(F.col("held"), most * blocks).when(
        F.col("source_size") > 0, F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"),
                                          most * blocks)).otherwise(0)
    return write_scratch(upto.withColumn("target", target).withColumns({"blocks": blocks, "quota": quota}).select(
        "number", "source", "source_size", "weight", "target", "blocks", "quota"), "mix-sources")


# ---------------------------------------------------------------- slots

def _draws(seed: int, given: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, n, ids, quotas) become (shard, id, n) with n > 0, a
    multinomial draw seeded by the columns ``given``."""
    for b in batches:
        rows = b.to_pydict()
        for i, shard in enumerate(rows["shard"]):
            rng = np.random.Generator(np.random.PCG64([seed, *(rows[c][i] for c in given)]))
            quotas = np.array(rows["quotas"][i], np.float64)
            n = rng.multinomial(rows["n"][i], quotas / quotas.sum())
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard] * len(at), pa.int64()),
                                              "id": pa.array(np.array(rows["ids"][i], np.int64)[at]),
                                              "n": pa.array(n[at].astype(np.int64))})


def draw_slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(shard, number, q): for every source the slots 0 to quota - 1, each in
    a shard, by multinomial draws settled to the quotas."""
    spark = sources.sparkSession
    some = sources.where(F.col("quota") > 0)
    groups = write_scratch(some.groupBy(((F.col("number") - 1) / GROUP).cast("long").alias("group")).agg(
        F.array_sort(F.collect_list(F.struct("number", "quota"))).alias("s"), F.sum("quota").alias("n")), "mix-groups")
    of_group = sorted((r.group, r.n) for r in groups.select("group", "n").collect())  # one row for 4,096 sources
    slots = sum(n for _, n in of_group)
    shards = spark.range(-(-slots // shard_slots)).select(
        F.col("id").alias("shard"),
        F.least(F.lit(shard_slots), F.lit(slots) - F.col("id") * shard_slots).cast("long").alias("n"))
    if not of_group:
        return shards.select("shard", F.col("n").alias("number"), F.col("n").alias("q"))
    ids, quotas = zip(*of_group, strict=True)
    result = "shard long, id long, n long"

    def by_group(batches):
        for b in batches:
            n = b.num_rows
            yield from _draws(seed, ["shard"], [pa.RecordBatch.from_pydict(
                {"shard": flat(b, "shard"), "n": flat(b, "n"), "ids": [ids] * n, "quotas": [quotas] * n})])

    grouped = shards.mapInArrow(by_group, result).withColumnRenamed("id", "group")
    inside = grouped.join(maybe_broadcast(groups.drop("n"), BROADCAST_GROUPS), "group").select(
        "shard", "group", "n", F.col("s.number").alias("ids"), F.col("s.quota").alias("quotas"))
    drawn = inside.mapInArrow(lambda it: _draws(seed + 1, ["shard", "group"], it), result).withColumnRenamed(
        "id", "number")
    # slots of a source, numbered through its shards
    numbered = prefix_sum(drawn, ["shard"], "n", "stop", ["number"], total="drawn")
    numbered = write_scratch(numbered.join(some.select("number", "quota"), "number"), "mix-draws")
    first = F.col("stop") - F.col("n")

    def each(df, start, stop):
        return df.select("shard", "number", F.explode(F.sequence(start, stop - 1)).alias("q"))

    kept = each(numbered.where(first < F.col("quota")), first, F.least("stop", "quota"))
    over = each(numbered.where(F.col("stop") > F.col("quota")), F.greatest(first, F.col("quota")), F.col("stop"))
    total = numbered.groupBy("number").agg(F.first("drawn").alias("drawn"))
    short = some.join(total, "number", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    short = each(short.where(F.col("drawn") < F.col("quota")).withColumn("shard", F.lit(0).cast("long")),
                 F.col("drawn"), F.col("quota"))
    over = row_number_global(over, ["shard", "number", "q"], name="i").select("i", "shard")
    short = row_number_global(short.drop("shard"), ["number", "q"], name="i")
    return kept.unionByName(short.join(over, "i").select("shard", "number", "q"))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Position ``i`` of a pseudorandom permutation of 0..n-1, one for each
    ``key``: four Feistel rounds over the next even number of bits, walked on
    until the number is below n."""
    half = np.maximum(np.ceil(np.log2(np.maximum(n, 2)) / 2), 1).astype(np.uint64)
    while len(low := np.flatnonzero(np.uint64(1) << (half * np.uint64(2)) < n.astype(np.uint64))):
        half[low] += np.uint64(1)  # where log2 was rounded down
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.arange(len(i))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in _ROUNDS:
            left, right = right, left ^ (mixed_bits(right + (k ^ r)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _blocks_of(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, number, q, blocks) with the block of each slot."""
    for b in batches:
        q, n, number = (flat(b, c).to_numpy() for c in ("q", "blocks", "number"))
        key = mixed_bits(mixed_bits(number.astype(np.uint64) + np.uint64(seed)) + (q // np.maximum(n, 1)).astype(np.uint64))
        block = permuted(q % np.maximum(n, 1), n, key) if len(q) else q
        yield pa.RecordBatch.from_arrays([flat(b, "shard"), flat(b, "number"), flat(b, "q"), pa.array(block)],
                                         names=["shard", "number", "slot", "block"])


# ---------------------------------------------------------------- the mix

def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3, block: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, seed: int = 13, id_col: str = "doc_id", source: str = "source",
                text: str = "text") -> Mix:
    """The mix of all documents, as spans of their words."""
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    d = write_scratch(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                                  F.xxhash64(body).alias("tag"),
                                  F.regexp_count(body, F.lit(WORD)).cast("long").alias("size")), "mix-docs")
    sources = source_targets(d, weights, most, block)
    d = join_on(d, maybe_broadcast(sources.select("source", "number"), GROUP * 16), ["source"])
    d = d.withColumn("deal", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tag")))
    placed = prefix_sum(d, ["deal", "doc_id", "tag", "size"], "size", "stop", ["number"])
    d = write_scratch(placed.select("doc_id", "source", "tag", "size", "number",
                                    (F.col("stop") - F.col("size")).alias("first")), "mix-docs")
    slots = draw_slots(sources, shard_slots, seed).join(
        maybe_broadcast(sources.select("number", "blocks"), GROUP * 16), "number")
    slots = slots.select("shard", "number", "q", "blocks").mapInArrow(
        lambda it: _blocks_of(seed, it), "shard long, number long, slot long, block long")
    parts = d.where(F.col("size") > 0).select("number", "first", "size", F.explode(F.sequence(
        F.expr(f"first div {block}"), F.expr(f"(first + size - 1) div {block}"))).alias("block"))
    begin = F.col("block") * block
    parts = parts.select("number", "block", "first", F.greatest(F.col("first") - begin, F.lit(0)).alias("part"),
                         F.greatest(begin - F.col("first"), F.lit(0)).alias("start"),
                         F.least(begin + block - F.col("first"), F.col("size")).alias("stop"))
    return Mix(d, sources, write_scratch(slots.join(parts, ["number", "block"]), "mix-spans"))


def words_taken(mix: Mix) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document."""
    taken = mix.spans.groupBy("number", "first").agg(F.sum(F.col("stop") - F.col("start")).alias("taken"))
    taken = taken.withColumn("some", F.lit(True))
    d = mix.docs.withColumn("some", F.col("size") > 0)  # only documents with words own their first word
    d = d.join(taken, ["number", "first", "some"], "left").join(
        maybe_broadcast(mix.sources.select("number", "source_size", "target"), GROUP * 16), "number")
    return d.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def block_texts(mix: Mix, docs: DataFrame, id_col: str = "doc_id", source: str = "source",
                text: str = "text") -> DataFrame:
    """(shard, number, slot, block, words): the mix itself, every slot with
    the words of its block."""
    body = F.coalesce(F.col(text), F.lit(""))
    bodies = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(body).alias("tag"),
                         body.alias("body")).dropDuplicates(["doc_id", "source", "tag"])
    named = join_on(mix.docs.where(F.col("size") > 0), bodies, ["doc_id", "source", "tag"])
    # the spans of a document, each block once: how often it is taken does not matter here
    cuts = mix.spans.select("number", "block", "first", "part", "start", "stop").distinct().groupBy(
        "number", "first").agg(F.collect_list(F.struct("block", "part", "start", "stop")).alias("cuts"))
    words = F.regexp_extract_all("body", F.lit(f"({WORD})"))
    pieces = named.join(cuts, ["number", "first"]).select(
        "number", words.alias("w"), F.explode("cuts").alias("c")).select(
        "number", "c.block", "c.part", F.slice("w", F.col("c.start").cast("int") + 1,
                                               (F.col("c.stop") - F.col("c.start")).cast("int")).alias("w"))
    blocks = pieces.groupBy("number", "block").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "w"))), lambda p: p["w"])).alias("words"))
    return mix.spans.select("shard", "number", "slot", "block").distinct().join(blocks, ["number", "block"]).select(
        "shard", "number", "slot", "block", "words")
