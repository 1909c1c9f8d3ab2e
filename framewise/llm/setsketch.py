"""Near-duplicate documents with SetSketch registers.

Every element of a set (a distinct five-word shingle) draws points of a
Poisson process on each register; a register keeps the smallest point over
the set.  Its logarithm to a base close to one, rounded and truncated to 16
bits, is the register value: minima of unions are minima of minima, so
sketches merge, and two registers are equal with a probability that follows
the Jaccard similarity.

1. One pass over the texts gives each document its set size, a 128-bit
   fingerprint of the set and the registers.  Equal sets become one class.
2. Bands of register values put classes into buckets.  A bucket's *leader* is
   the member that shares the most buckets with others (a group's origin
   shares more with its copies than the copies do among themselves); every
   member is paired with the leader only.
3. The joint maximum-likelihood estimate of the similarity prunes pairs that
   are far below the threshold; the rest is confirmed on the full sets.
4. Components of the confirmed links come from alternating large-star and
   small-star steps.
5. Buckets whose members are still in several components go on.  In small
   ones (``SMALL`` members) all pairs across components are tried.  In large
   ones members are compared by what sets them apart from a reference, the
   shingles that most members of the group hold: see ``_differ``.  Members
   that share a difference are paired where the numbers of their differences
   leave a link possible; if more than ``SHARED`` members share something
   beyond the reference, they are a bucket of the next round, until none is
   left.  So m copies that differ from their origin each in its own way cost a
   multiple of m, never all pairs.

With 24 bands of 6 registers a pair at similarity 0.85 shares no bucket with
probability 1.2e-5 (0.9: 1e-8); at 0.80 28 bands of 5 miss one with 1.5e-5.

Defined results.  Null or empty text or no words: an empty set, linked with
nothing.  Null id: the row belongs to its class but names nothing; it is kept
if the whole class has no id.  Repeated rows: equal sets, one class; rows that
repeat an id with other texts are classed row by row.  Empty table: empty
result.  Input columns other than id and text are not carried.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import (bounded_batches, byte_codes, drop_scratch, flat, keep_scratch, maybe_broadcast, mix,
                                  signed, utf8, word_hashes, write_scratch)
from framewise.session import scratch_written

SHINGLE = 5
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
#: Base of the logarithm, and the smallest point kept apart; 16 bits hold the rest.
BASE, SMALLEST = 1.0005, 1e-13
#: A pair is pruned if its estimate is this many standard errors below the threshold.
ERRORS = 6.0
#: Members of a bucket up to which all its open pairs are tried; of a set of
#: members that share a difference, where a bound leaves few of them.
SMALL, SHARED = 12, 256
#: Candidate rows (16 bytes) a task of the smaller tables takes.
TASK_ROWS = 100_000
#: Members checked against one copy of their leader's text.
CHUNK = 256
#: Rows of up to 24 bytes up to which a counted table is broadcast (24 MB).
BROADCAST_ROWS = 1_000_000


def shingles(h: np.ndarray, first: np.ndarray, size: int = SHINGLE):
    """Distinct shingles of every text: hashes, and the index of each text's
    first one.  Fewer words than ``size`` make one shingle, none make none."""
    texts = len(first) - 1
    words = np.diff(first)
    doc = np.repeat(np.arange(texts), words)
    parts, docs = [], []
    if len(h) >= size:
        acc = h[:len(h) - size + 1] + np.uint64(size)
        for k in range(1, size):
            acc = mix(acc) ^ h[k:len(h) - size + 1 + k]
        own = doc[:len(acc)] == doc[size - 1:]
        parts.append(mix(acc)[own])
        docs.append(doc[:len(acc)][own])
    for d in np.flatnonzero((words > 0) & (words < size)):
        acc = np.full(1, words[d], np.uint64)
        for w in h[first[d]:first[d + 1]]:
            acc = mix(acc) ^ w
        parts.append(mix(acc))
        docs.append(np.array([d]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    value, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(texts + 1))


def registers(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Smallest point of every register, one row for each text.

    Element x's k-th point follows its (k-1)-th after an exponential time of
    rate REGISTERS and falls on a random register, so each register gets
    points of rate one.  An element stops at the largest minimum so far."""
    texts = len(first) - 1
    least = np.full((texts, REGISTERS), np.inf)
    flat_least = least.reshape(-1)
    doc = np.repeat(np.arange(texts), np.diff(first))
    x, time, k = sets, np.zeros(len(sets)), 0
    while len(x):
        k += 1
        u = mix(x + np.uint64((k * 0xD1342543DE82EF95) % 2**64))
        time = time - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        slot = (mix(u ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(33)) % np.uint64(REGISTERS)
        np.minimum.at(flat_least, doc * REGISTERS + slot.astype(np.int64), time)
        live = doc[np.append(True, doc[1:] != doc[:-1])]  # texts that still have elements
        on = time < least[live].max(axis=1)[np.searchsorted(live, doc)]
        x, time, doc = x[on], time[on], doc[on]
    return least


def quantised(least: np.ndarray) -> np.ndarray:
    """Register values: exponents of BASE, truncated to 16 bits."""
    top = np.log(np.maximum(least, SMALLEST) / SMALLEST) / np.log(BASE)
    return np.minimum(65535, np.floor(np.where(np.isinf(least), np.inf, top))).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.minimum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketched sets of known sizes:
    a register of the first is lower, equal or higher than that of the second
    with probabilities that depend on the similarity alone."""
    lower, higher = (a < b).sum(1), (a > b).sum(1)
    equal = a.shape[1] - lower - higher
    u, v = na / (na + nb), nb / (na + nb)
    c = (BASE - 1) / BASE

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * c) / np.log(BASE)

    def likelihood(j):
        only_a, only_b = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (lower * np.log(np.maximum(only_a, tiny)) + higher * np.log(np.maximum(only_b, tiny))
                + equal * np.log(np.maximum(1 - only_a - only_b, tiny)))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        one, two = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        rise = likelihood(one) < likelihood(two)
        lo, hi = np.where(rise, one, lo), np.where(rise, hi, two)
    return (lo + hi) / 2


def _sketch(batches):
    codes = byte_codes("space", True)
    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, _, _, word = word_hashes(data, offsets, codes)
        value, first = shingles(h, word)
        regs = quantised(registers(value, first))
        total = np.zeros((2, len(value) + 1), np.uint64)
        np.cumsum(value, out=total[0, 1:])
        np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
        prints = total[:, first[1:]] - total[:, first[:-1]]
        yield pa.RecordBatch.from_arrays(
            [flat(batch, "id"), pa.array(np.diff(first).astype(np.int64)),
             pa.array(signed(prints[0])), pa.array(signed(prints[1])),
             pa.array([r.tobytes() for r in regs], pa.binary())],
            names=["id", "n", "p", "q", "regs"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, p, q, regs): set size, fingerprint and registers of each row."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_sketch, "id long, n long, p long, q long, regs binary")


def _prune(batches, threshold: float):
    for batch in batches:
        cols = {c: flat(batch, c) for c in ("ra", "rb", "na", "nb")}
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(cols[c].to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
        j = estimate(a, b, *(cols[c].to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb")))
        error = np.sqrt(threshold * (1 - threshold) / REGISTERS)
        yield batch.select(["a", "b"]).filter(pa.array(j >= threshold - ERRORS * error))


def _members(batches):
    """(leader, its set, member, its set) from rows sorted by group, in which
    the leader's text comes before those of the members."""
    codes, own, group = byte_codes("space", True), None, None
    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, _, _, word = word_hashes(data, offsets, codes)
        value, first = shingles(h, word)
        rows = zip(flat(batch, "a").to_pylist(), flat(batch, "salt").to_pylist(),
                   flat(batch, "b").to_pylist(), strict=True)
        for i, (a, salt, b) in enumerate(rows):
            mine = value[first[i]:first[i + 1]]
            if b is None:
                own, group = mine, (a, salt)
            elif group == (a, salt):
                yield a, own, b, mine


def _confirm(batches, percent: int):
    out: list[tuple[int, int]] = []
    for a, own, b, mine in _members(batches):
        both = len(np.intersect1d(own, mine, assume_unique=True))
        if 100 * both >= percent * (len(own) + len(mine) - both):
            out.append((a, b))
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _majority(batches):
    """(a, reference): the shingles that more than half of a leader's first
    group of members hold."""
    out, group, sets = [], None, []

    def close():
        if group and group[1] == 0:
            value, n = np.unique(np.concatenate(sets), return_counts=True)
            out.append((group[0], value[2 * n > len(sets)]))

    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, _, _, word = word_hashes(data, offsets, byte_codes("space", True))
        value, first = shingles(h, word)
        rows = zip(flat(batch, "a").to_pylist(), flat(batch, "salt").to_pylist(), strict=True)
        for i, key in enumerate(rows):
            if key != group:
                close()
                group, sets = key, []
            if key[1] == 0:
                sets.append(value[first[i]:first[i + 1]])
    close()
    yield pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in out], pa.int64()), pa.array([r.tobytes() for _, r in out], pa.binary())],
        names=["a", "reference"])


#: Words of 64 bits of a set's parity map.
MAP_WORDS = 16
_MAP = [f"m{i}" for i in range(MAP_WORDS)]
_DIFFERENCES = ["key", "pos", "a", "rep", "side", "added", "gone", "n", *_MAP]


def _parity_map(sets: np.ndarray) -> np.ndarray:
    """Each bit tells whether an odd number of the set's elements fall on it.
    The maps of x and y differ in at most |x delta y| bits: elements of both
    cancel out, any other turns one bit."""
    bit = mix(sets ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(64 * MAP_WORDS)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * MAP_WORDS) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _differ(batches, percent: int):
    """What members have beyond the reference set of their leader's group
    (side 0) and what they lack of it (side 1), with the numbers of both; and a
    row of side 2 for every member, those equal to the reference included.

    For any reference c, (x delta c) delta (y delta c) = x delta y.  A link means
    |x delta y| <= k (|x| + |y|), k = (100 - percent) / (100 + percent), which is
    at most k (1 + 100 / percent) times |x| (or |y|).  If x and y share
    differences, the first of them in a fixed order that puts side 0 first is
    among the first |x delta y| + 1 of each, as those before it count into
    x delta y.  If they share none, see ``_centres``."""
    k = (100 - percent) / (100 + percent)
    codes, own, group, parts, held = byte_codes("space", True), None, None, [], 0

    def rows():
        columns = [np.concatenate([p[i] for p in parts]) for i in range(len(_DIFFERENCES))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_DIFFERENCES)

    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, _, _, word = word_hashes(data, offsets, codes)
        value, first = shingles(h, word)
        names = ("a", "salt", "b", "reference")
        for i, (a, salt, b, reference) in enumerate(zip(*(flat(batch, c).to_pylist() for c in names), strict=True)):
            mine = value[first[i]:first[i + 1]]
            if b is None:
                own, group = np.frombuffer(reference, np.uint64), (a, salt)
                continue
            if group != (a, salt):
                continue
            added = np.setdiff1d(mine, own, assume_unique=True)
            gone = np.setdiff1d(own, mine, assume_unique=True)
            most = int(k * (1 + 100 / percent) * len(mine)) + 2
            leader = mix(np.full(1, a, np.int64).view(np.uint64))
            bits = _parity_map(mine)
            every = np.zeros(1, np.uint64)
            for side, some in ((0, added[:most]), (1, gone[:max(0, most - len(added))]), (2, every)):
                key = mix(mix(some ^ leader) + np.uint64(side))
                parts.append((signed(key), np.arange(len(key)), *(np.full(len(key), v, np.int64) for v in (
                    a, b, side, len(added), len(gone), len(mine), *bits))))
                held += len(key)
            if held > 100_000:
                yield rows()
                parts, held = [], 0
    if parts:
        yield rows()


def _centres(apart: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Pairs (a, b) that stand for all links of members without a shared
    difference: each group's member m of the largest slack with all others that
    make up for it.

    With d(x) differences from the reference let slack(x) = k |x| - d(x).
    Members that share no difference are linked if and only if their slacks add
    up to no less than 0, and any two whose slacks do are linked, as shared
    differences only bring them closer.  So if x and y are linked this way, m is
    linked with both, and all three are one component."""
    own = apart.where("side = 2").select("a", "rep", (
        (100 - percent) * F.col("n") - (100 + percent) * (F.col("added") + F.col("gone"))).alias("slack"))
    best = own.groupBy("a").agg(F.max(F.struct("slack", "rep")).alias("m")).select(
        "a", F.col("m.rep").alias("m"), F.col("m.slack").alias("most"))
    best = write_scratch(best, "centres", tasks)
    return (own.join(maybe_broadcast(best, BROADCAST_ROWS), "a").where("rep <> m and slack + most >= 0")
            .select(F.col("m").alias("a"), F.col("rep").alias("b")).distinct())


def _lacking(apart: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a key of side 1, of which one is outside the
    component of their leader, and that may be linked without sharing anything
    beyond the reference, if that is the first they both lack."""
    at = _with_comp(apart.where("side = 1"), comp)
    main = comp.select(F.col("rep").alias("a"), F.col("comp").alias("main"))
    outside = at.join(maybe_broadcast(main, BROADCAST_ROWS), "a", "left").where(
        F.col("comp") != F.coalesce("main", "a")).drop("main")
    differ = F.col("added1") + F.col("added2") + F.col("gone1") + F.col("gone2")
    common = F.least(F.col("gone1") - F.col("pos1"), F.col("gone2") - F.col("pos2"))
    return _pairs(outside, at, percent, (
        (100 + percent) * (differ - 2 * common) <= (100 - percent) * (F.col("n1") + F.col("n2"))))


def _along(apart: DataFrame, sizes: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of side 0 that share a key of ``sizes`` and may be linked
    if that is the first added shingle they share: of the added ones those from
    there on can be common to both, of the missing ones all."""
    at = apart.where("side = 0").join(maybe_broadcast(sizes.select("key"), BROADCAST_ROWS), "key", "left_semi")
    at = _with_comp(at, comp)
    differ = F.col("added1") + F.col("added2") + F.col("gone1") + F.col("gone2")
    common = F.least(F.col("added1") - F.col("pos1"), F.col("added2") - F.col("pos2")) + F.least("gone1", "gone2")
    return _pairs(at, at, percent, (F.col("rep1") < F.col("rep2")) & (
        (100 + percent) * (differ - 2 * common) <= (100 - percent) * (F.col("n1") + F.col("n2"))))


def _with_comp(rows: DataFrame, comp: DataFrame) -> DataFrame:
    return rows.join(maybe_broadcast(comp, BROADCAST_ROWS), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def _pairs(x: DataFrame, y: DataFrame, percent: int, link) -> DataFrame:
    """Pairs (a, b) of rows with a common key for which ``link`` holds and whose
    parity maps leave a link possible: |x delta y| is at least the number of
    bits in which they differ."""
    x, y = (d.select("key", *[F.col(c).alias(f"{c}_{i}" if c in _MAP else f"{c}{i}") for c in (
        "pos", "rep", "comp", "added", "gone", "n", *_MAP)]) for i, d in ((1, x), (2, y)))
    least = functools.reduce(operator.add, [F.bit_count(F.col(f"{c}_1").bitwiseXOR(F.col(f"{c}_2"))) for c in _MAP])
    link = link & ((100 + percent) * least <= (100 - percent) * (F.col("n1") + F.col("n2")))
    return x.join(y, "key").where((F.col("comp1") != F.col("comp2")) & link).select(
        F.least("rep1", "rep2").alias("a"), F.greatest("rep1", "rep2").alias("b")).distinct()


def _beside_leaders(pairs: DataFrame, texts: DataFrame, tasks: int) -> DataFrame:
    """(a, salt, b, text): the texts of the members b of every leader a, in
    groups of about CHUNK, each led by a row with the leader's own (b null)."""
    members = write_scratch(pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("salts")), "leaders", tasks)
    salted = pairs.join(maybe_broadcast(members, BROADCAST_ROWS), "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), "b")
    lead = members.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                          F.lit(None).cast("long").alias("b"))
    wanted = write_scratch(salted.withColumn("rep", F.col("b")).unionByName(
        lead.withColumn("rep", F.col("a"))), "wanted", tasks)
    return _grouped(texts.join(maybe_broadcast(wanted, BROADCAST_ROWS), "rep").select("a", "salt", "b", "text"))


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows dealt by (a, salt), in each partition group after group, leaders first."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, tasks: int) -> DataFrame:
    """The pairs (a, b) of class ids whose full sets reach the threshold."""
    known = classes.select("rep", "n", "regs")
    size_ok = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    near = (known.withColumnsRenamed({"rep": "a", "n": "na", "regs": "ra"})
            .join(maybe_broadcast(pairs, BROADCAST_ROWS), "a"))
    near = (near.join(known.withColumnsRenamed({"rep": "b", "n": "nb", "regs": "rb"}), "b")
            .where(size_ok).select("a", "b", "na", "nb", "ra", "rb")
            .mapInArrow(lambda it: _prune(it, percent / 100), "a long, b long"))
    near = write_scratch(near.distinct(), "near-pairs", tasks)
    links = _beside_leaders(near, texts, tasks).mapInArrow(lambda it: _confirm(it, percent), "a long, b long")
    return write_scratch(links, "near-links", tasks)


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): the smallest id reachable over links (a, b), by large-star
    and small-star steps on written tables; unlinked ids are left out.  What a
    join meets is always read from a written table, so that the rows of a
    node with very many links can be split over tasks.  The rounds end when one
    changes nothing (about log2 of a component's size)."""
    tasks = -(-links.count() // TASK_ROWS) or 1
    edges = write_scratch(
        links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
        .where("u <> v").distinct(), "cc", tasks)
    before = None
    while True:
        # large star: larger neighbours of each node link to its smallest one
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = write_scratch(least.select("u", F.least("u", "m").alias("m")), "cc", tasks)
        large = (both.where("v > u").join(maybe_broadcast(least, BROADCAST_ROWS), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: smaller neighbours and the node itself link to the smallest
        large = write_scratch(large.where("u <> v").distinct(), "cc", tasks)
        low = write_scratch(large.groupBy("u").agg(F.min("v").alias("m")), "cc", tasks)
        small = (large.join(maybe_broadcast(low, BROADCAST_ROWS), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", "m")).where("u <> v").distinct())
        small = write_scratch(small, "cc", tasks)
        for old in (edges, least, large, low):
            drop_scratch(old)
        edges = small
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("comp"))


def _sizes(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """(key, size) of the keys that several rows of (key, rep) share."""
    return write_scratch(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes", tasks)


def _buckets(rows: DataFrame, sizes: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """(key, rep, size) of the rows of (key, rep) with a key of ``sizes``."""
    return write_scratch(rows.join(maybe_broadcast(sizes, BROADCAST_ROWS), "key"), name, tasks)


def _stars(buckets: DataFrame, tasks: int) -> DataFrame:
    """(key, a): the leader of every bucket."""
    fame = write_scratch(buckets.groupBy("rep").agg(F.sum("size").alias("fame")), "fame", tasks)
    top = buckets.join(maybe_broadcast(fame, BROADCAST_ROWS), "rep").groupBy("key").agg(
        F.max(F.struct("fame", (-F.col("rep")).alias("rep"))).alias("top"))
    return write_scratch(top.select("key", (-F.col("top.rep")).alias("a")), "stars", tasks)


def _open(buckets: DataFrame, comp: DataFrame, tasks: int) -> DataFrame:
    """(key, rep, size, comp) of the buckets whose members are in several components."""
    member = buckets.join(maybe_broadcast(comp, BROADCAST_ROWS), "rep", "left").select(
        "key", "rep", "size", F.coalesce("comp", "rep").alias("comp"))
    mixed = member.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    mixed = write_scratch(mixed.select("key"), "mixed", tasks)
    return write_scratch(member.join(maybe_broadcast(mixed, BROADCAST_ROWS), "key", "left_semi"), "open", tasks)


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """Distinct pairs that were not tried, in either order."""
    return pairs.distinct().join(tried, ["a", "b"], "left_anti").join(
        tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    percent: int = 85, rows_per_band: int = ROWS) -> DataFrame:
    """(id, n_shingles, class_id, component_id, kept) for every row of ``docs``:
    documents whose shingle sets have a Jaccard similarity of at least
    ``percent`` % are linked, and a component keeps its smallest id.  Bands take
    ``rows_per_band`` registers each, as many as there are."""
    spark = docs.sparkSession
    mark = scratch_written(spark)
    sk = write_scratch(sketches(docs, id_col, text), "sketches")
    per_class = sk.where("n > 0").groupBy("n", "p", "q").agg(
        F.min("id").alias("rep"), F.first("regs").alias("regs"))
    classes = write_scratch(per_class, "classes")
    named = classes.where(F.col("rep").isNotNull())
    band = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // rows_per_band - 1)),
        lambda i: F.xxhash64(i, F.substring("regs", i * (2 * rows_per_band) + 1, F.lit(2 * rows_per_band)))))
    banded = write_scratch(named.select("rep", band.alias("key")), "bands")
    buckets = _buckets(banded, _sizes(banded), "buckets")
    drop_scratch(banded)
    tasks = -(-buckets.count() // TASK_ROWS) or 1
    reps = write_scratch(buckets.select("rep").distinct(), "reps", tasks)
    texts = write_scratch(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text).alias("text"))
                          .join(maybe_broadcast(reps, BROADCAST_ROWS), "rep", "left_semi"), "texts")

    nothing = spark.createDataFrame([], "a long, b long")
    tried, links, extra, comp = nothing, nothing, nothing, nothing.selectExpr("a rep", "b comp")
    while True:
        stars = _stars(buckets, tasks)
        led = buckets.join(maybe_broadcast(stars, BROADCAST_ROWS), "key").where("a <> rep")
        pairs = led.select("a", F.col("rep").alias("b")).unionByName(extra).distinct()
        pairs = write_scratch(pairs.join(tried, ["a", "b"], "left_anti"), "pairs", tasks)
        if not pairs.isEmpty():
            links = write_scratch(links.unionByName(confirmed(pairs, named, texts, percent, tasks)), "links", tasks)
            tried = write_scratch(tried.unionByName(pairs), "tried", tasks)
            comp = write_scratch(components(links), "comp", tasks)
        members = _open(buckets, comp, tasks)
        few = members.where(F.col("size") <= SMALL)  # buckets of later rounds are larger
        extra = few.alias("l").join(few.alias("r"), F.expr(
            "l.key = r.key and l.rep < r.rep and l.comp <> r.comp")).select(
            F.col("l.rep").alias("a"), F.col("r.rep").alias("b"))
        extra = write_scratch(_untried(extra, tried), "extra", tasks)
        many = members.where(F.col("size") > SMALL).join(maybe_broadcast(stars, BROADCAST_ROWS), "key")
        many = write_scratch(many.where("a <> rep").select("a", F.col("rep").alias("b")).distinct(), "large", tasks)
        if many.isEmpty():
            if not extra.isEmpty():
                links = links.unionByName(confirmed(extra, named, texts, percent, tasks))
                comp = write_scratch(components(write_scratch(links, "links", tasks)), "comp", tasks)
            break
        rows = write_scratch(_beside_leaders(many, texts, tasks), "beside")
        reference = write_scratch(_grouped(rows.where("salt = 0")).mapInArrow(
            _majority, "a long, reference binary"), "references", tasks)
        lead = rows.where("b is null").join(reference, "a")
        led = _grouped(rows.where("b is not null").withColumn("reference", F.lit(None).cast("binary"))
                       .unionByName(lead))
        apart = write_scratch(led.mapInArrow(
            lambda it: _differ(it, percent), ", ".join(f"{c} long" for c in _DIFFERENCES)), "differences")
        shared = apart.where("side = 0").select("key", "rep")
        sizes = _sizes(shared, tasks)
        extra = extra.unionByName(_centres(apart, percent, tasks)).unionByName(_lacking(apart, comp, percent)).unionByName(
            _along(apart, sizes.where(F.col("size") <= SHARED), comp, percent))
        extra = write_scratch(_untried(extra, tried), "extra", tasks)
        buckets = _open(_buckets(shared, sizes.where(F.col("size") > SHARED), "buckets", tasks), comp, tasks)
        buckets = buckets.drop("comp")

    keep_scratch(spark, mark, sk, classes, *([comp] if hasattr(comp, "_scratch") else []))
    found = classes.select("n", "p", "q", "rep").join(maybe_broadcast(comp, BROADCAST_ROWS), "rep", "left").select(
        "n", "p", "q", "rep", F.coalesce("comp", "rep").alias("comp"))
    out = sk.select("id", "n", "p", "q").join(found, ["n", "p", "q"], "left")
    component = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("id"))
    return out.select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("id")).alias("class_id"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), component.isNull()).alias("kept"))
