"""Collocations, the conversation trie and the source mix: whole small tables,
odd rows, hot keys, empty tables."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import brute as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import collocations, mixing, prefix_trie, queries

KEY = lambda r: tuple((x is None, x if x is not None else 0) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, want), key=KEY)


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- collocations

def test_collocation_query(spark, sf_small):
    docs = [(r.lang, r.text) for r in table(spark, sf_small, "documents").collect()]
    got = queries.op11_collocations(spark, sf_small).collect()
    same(got, B.collocations(docs))
    assert {len(r.phrase.split()) for r in got} == {2, 3}


@pytest.mark.parametrize(("words", "least", "percent", "top"), [(2, 1, 50, 10), (3, 2, 100, 2000), (5, 3, 40, 7)])
def test_collocation_parameters(spark, words, least, percent, top):
    rng = random.Random(words)
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choice("a b c D e. f g, the the the".split())
                                                     for _ in range(rng.randrange(60)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    same(collocations.collocations(df, words, least, percent, top).collect(),
         B.collocations(rows, words, least, percent, top))


def test_collocations_of_odd_rows(spark, edge, empty):
    langs = F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("source"))
    rows = edge.select(langs.alias("lang"), "text", F.lit(1).alias("phrase"), F.lit("x").alias("n"))
    want = B.collocations([(r.lang, r.text) for r in rows.collect()], least=2)
    same(collocations.collocations(rows, least=2).collect(), want)
    assert collocations.collocations(empty.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_hot_prefixes_are_sliced_and_split_stripes_meet(spark, monkeypatch):
    """One prefix before a third of all words; stripes of many small flushes."""
    rng = random.Random(7)
    rows = [("en", " ".join(f"hot w{rng.randrange(400)} x{rng.randrange(9)}" for _ in range(200))) for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    same(collocations.collocations(df, least=3).collect(), B.collocations(rows, least=3))
    levels = collocations.phrase_counts(df, 2, 1)
    hot = levels[1].groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("next")).alias("n"))
    assert hot.orderBy(F.desc("n")).first().rows > 100  # its counter is in many slices
    spread = levels[1].select("key", F.explode("next").alias("w"))
    assert spread.count() == spread.distinct().count()  # an entry is in one slice only


def test_scores_are_exact_beyond_64_bits(spark):
    """The score's formula on counts whose products pass 64 bits."""
    a, left, right = 4 * 10**12 + 7, 5 * 10**12 + 3, 6 * 10**12 + 1
    whole = "decimal(15,0)"
    got = spark.range(1).select(F.expr(
        f"(cast({a} as {whole}) * cast({a} as {whole}) * cast(1000000 as decimal(7,0))) div "
        f"(cast({left} as {whole}) * cast({right} as {whole}))")).first()[0]
    assert got == 10**6 * a * a // (left * right)


# ---------------------------------------------------------------- trie

def trie(df, run_rows=prefix_trie.RUN_ROWS):
    return prefix_trie.trie_of(prefix_trie.rebuilt(prefix_trie.conversations(df)), run_rows).collect()


def test_trie_query(spark, sf_small):
    rows = [tuple(r) for r in table(spark, sf_small, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    same(queries.op12_prefix_trie(spark, sf_small).collect(), B.prefix_trie(rows))


@pytest.mark.parametrize("run_rows", [1, 2, 7, 1000])
def test_trie_across_runs(spark, run_rows):
    """Few different turns, so that nodes and hot groups of equal
    conversations span many runs."""
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "a b"]))
            for c in range(150) for t in range(rng.randrange(1, 7))]
    rows += [(1000 + c, t, "user", "the same words here") for c in range(100) for t in range(4)]
    rows += [(2000, t, "user", f"turn {t % 3}") for t in range(300)]  # one long conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    same(trie(df, run_rows), B.prefix_trie(rows))


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (None, None, None, None), (0, 1, None, "x y"), (0, None, "user", None),
            (0, 1, None, "x y"), (5, 0, "user", ""), (5, 0, "", "user"), (-7, 0, "user", "x"), (-20, 0, "user", "neg"),
            (-33, 0, "a", "b"), (-33, 1, "a", "b c"), (41, 0, "user", "no base"), (7, 3, "user", "w " * 50_000),
            (8, 3, "user", "w " * 50_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, turns string, n_convs int")
    same(trie(df), B.prefix_trie(rows))
    assert trie(df.where("false")) == []
    same(trie(df.where("conv_id is null")), B.prefix_trie(rows[:2]))


def test_forest_of_neighbours():
    """Union-find merges equal, nested and branching conversations."""
    f = prefix_trie._Forest(np.array([2, 2, 1, 3]), np.array([0, 2, 1, 1]))  # ab ab a acd
    real = [v for v in range(len(f.depth)) if f.node_of(v) == v]
    assert Counter(f.depth[v] for v in real) == {0: 1, 1: 1, 2: 2, 3: 1}
    assert f.node_of(0) == f.node_of(1) and f.depth[f.node_of(2)] == 1
    top = f.node_of(2)
    assert (f.low[top], f.high[top]) == (0, 3)


# ---------------------------------------------------------------- mix

def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above the bound is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in held)
        share = Fraction(left, sum(w[s] for s in names if s not in held) or 1)
        above = {s for s in names if s not in held and share * w[s] > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in held else float(share * w[s]) for s in names}
        held |= above


def check_mix(rows, got, block=mixing.BLOCK_WORDS):
    """rows: (doc_id, source, text); got: rows of words_taken with source."""
    size = Counter()
    for _, s, t in rows:
        size[s] += len(B.WORD.findall(t or ""))
    targets = plain_targets(size)
    same([(r.doc_id, r.source, r.size, r.source_size) for r in got],
         [(i, s, len(B.WORD.findall(t or "")), size[s]) for i, s, t in rows])
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(1.5 * block, 0.001 * target) and taken[s] <= 3 * size[s]


def test_mix_query(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    got = queries.op13_source_mix(spark, sf_small)
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint",
                                "target": "double", "taken": "bigint"}
    again = mixing.words_taken(mixing.mix_sources(docs.repartition(5)))
    same(got.collect(), again.drop("source").collect())  # reruns agree
    check_mix([(r.doc_id, r.source, r.text) for r in docs.collect()], again.collect())


def test_blocks_hold_the_words(spark, sf_small):
    """Every slot's text is the block that its number names; a pass takes
    every block once."""
    docs = table(spark, sf_small, "documents")
    mix = mixing.mix_sources(docs, block=100, shard_slots=50)
    text = {r.doc_id: B.WORD.findall(r.text or "") for r in docs.collect()}
    packed = defaultdict(list)
    for r in mix.docs.orderBy("number", "first").collect():
        assert r.size == 0 or r.first == len(packed[r.number])
        packed[r.number] += text[r.doc_id]
    blocks = {r.number: r.blocks for r in mix.sources.collect()}
    passes = defaultdict(list)
    slots = mixing.block_texts(mix, docs).collect()
    for r in slots:
        assert r.words == packed[r.number][r.block * 100:(r.block + 1) * 100]
        passes[r.number, r.slot // blocks[r.number]].append(r.block)
    for (number, _), found in passes.items():
        assert len(found) == len(set(found)) and max(found) < blocks[number]
    quota = {r.number: r.quota for r in mix.sources.collect()}
    assert Counter(r.number for r in slots) == Counter({k: v for k, v in quota.items() if v})
    shards = Counter(r.shard for r in slots)
    assert sorted(shards.values())[1:] == [50] * (len(shards) - 1)  # all but the last are full


def test_mix_of_odd_rows(spark, edge, empty):
    rows = [(r.doc_id, r.source, r.text) for r in edge.collect()]
    got = mixing.mix_sources(edge.withColumn("size", F.lit("clash")).withColumn("number", F.lit(0)), block=8)
    check_mix(rows, mixing.words_taken(got).collect(), 8)
    assert mixing.words_taken(mixing.mix_sources(empty)).count() == 0
    nothing = edge.where("doc_id in (0, 1, 2)")
    assert [(r.target, r.taken) for r in mixing.words_taken(mixing.mix_sources(nothing)).collect()] == [(0.0, 0)] * 3


def test_hot_and_tiny_sources(spark, monkeypatch):
    """A source with most words, many small ones, several groups of sources."""
    monkeypatch.setattr(mixing, "GROUP", 4)
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"s{rng.randrange(30):02d}", "w " * rng.randrange(200)) for i in range(400)]
    rows += [(1000, "tiny", "one two"), (1001, None, "no source " * 30), (1002, "", "blank name " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    mix = mixing.mix_sources(df, block=4, shard_slots=300)
    check_mix(rows, mixing.words_taken(mix).collect(), 4)
    drawn = mix.spans.groupBy("shard").agg(F.countDistinct("number", "slot").alias("n")).collect()
    assert len(drawn) > 10 and sum(r.n == 300 for r in drawn) == len(drawn) - 1


def test_permutation():
    n = np.repeat([1, 2, 3, 4, 5, 63, 64, 65, 1000], [1, 2, 3, 4, 5, 63, 64, 65, 1000])
    i = np.concatenate([np.arange(k) for k in (1, 2, 3, 4, 5, 63, 64, 65, 1000)])
    out = mixing.permuted(i, n, np.full(len(n), 99, np.uint64))
    for k in np.unique(n):
        assert sorted(out[n == k]) == list(range(k))
    big = mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 5, np.uint64))
    assert list(big) != list(out[n == 1000]) and abs(np.corrcoef(big, np.arange(1000))[0, 1]) < 0.15
