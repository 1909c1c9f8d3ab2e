"""Stems, polarity, binned densities, the smoother and search on edge lists."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.functions import stemming as sm
from framewise.operators import network as nw
from framewise.operators import stats as st
from framewise.operators import text as tt
from framewise.sources import lexicons

# Published sample pairs of the stemmer.
PAIRS = """
consign consign consigned consign consigning consign consignment consign consist consist consisted consist
consistency consist consistent consist consistently consist consisting consist consists consist
consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol
consolidate consolid consolidated consolid consolidating consolid consoling consol consols consol
consonant conson consort consort consorted consort consorting consort conspicuous conspicu
conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir
conspired conspir conspiring conspir constable constabl constables constabl constance constanc
constancy constanc constant constant knack knack knackeries knackeri knacks knack knag knag knave knave
knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeled kneel kneeling kneel
kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight
knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive knob knob
knobs knob knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock
knopp knopp knot knot knots knot
caresses caress ties tie cries cri gas gas this this gaps gap kiwis kiwi
hopping hop hoping hope falling fall hissing hiss failing fail filing file luxuriated luxuri agreed agre feed feed
cry cri by by say say enjoy enjoy dying die skis ski news news inning inning proceed proceed
relational relat conditional condit rational ration valenci valenc digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal
sensitiviti sensit sensibiliti sensibl triplicate triplic formative format formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt communism communism activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
general general generate generat commune commune communication communic arsenal arsenal arsenic arsenic
""".split()


def test_published_stems(spark):
    want = dict(zip(PAIRS[::2], PAIRS[1::2]))
    want["generate"] = "generat"
    df = spark.createDataFrame([(w,) for w in want], "word string")
    got = {r.word: r.stem for r in sm.stems_of(df).collect()}
    assert {w: s for w, s in got.items() if s != want[w]} == {}


def test_stems_of_odd_words(spark):
    words = ["", "a", "is", "42", "ß", "été", "yes", "youth", "boyish", "sayyid", "'em", "dog's", "x" * 3000 + "ing", None]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.stem for r in sm.stem_column(df).collect()}
    assert got[""] == "" and got["is"] == "is" and got["42"] == "42" and got["été"] == "été" and got[None] is None
    assert got["youth"] == "youth" and got["boyish"] == "boyish" and got["dog's"] == "dog"
    assert got["x" * 3000 + "ing"] == "x" * 3000 + "ing"  # no vowel before the ending


def test_a_word_is_stemmed_once(spark):
    """The cascade stands on the distinct words; rows meet it by a join."""
    rows = spark.createDataFrame([(w,) for w in ["running", "runs", "running"] * 50], "word string")
    counts = tt.stem_counts(rows)
    assert [(r.stem, r.n) for r in counts.collect()] == [("run", 150)]
    text = spark.createDataFrame([(1, "x", "The Cats' 3 running/DOGS!"), (2, "y", ""), (3, None, None)],
                                 "page int, document string, text string")
    got = {r.page: r.clean for r in tt.clean_text(text, ["the"]).collect()}
    assert got == {1: "cat runningdog", 2: "", 3: None}


def test_polarity_equals_a_plain_count(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["good", "fine", "plain"] if y else ["bad", "plain", "plain", "odd"]), y)
            for y in (0, 1) for _ in range(300)] + [("rare", 1)] * 3 + [("none", None)] * 50 + [("two", 2)] * 50
    got = {r.word: (r.sentiment, r.weight) for r in tt.polarity(
        spark.createDataFrame(rows, "word string, y int"), "y").collect()}
    n = Counter(r for r in rows if r[1] in (0, 1))
    p, q = (sum(v for (_, y), v in n.items() if y == k) for k in (1, 0))
    want = {}
    for w in {w for w, _ in n}:
        a = 500 * (n[w, 1] + n[w, 0]) / (p + q)
        weight = (math.log((n[w, 1] + a) / (p + 500 - n[w, 1] - a)) - math.log((n[w, 0] + a) / (q + 500 - n[w, 0] - a)))
        if n[w, 1] + n[w, 0] >= 10 and abs(weight) >= 1.96 * math.sqrt(1 / (n[w, 1] + a) + 1 / (n[w, 0] + a)):
            want[w] = ("positive" if weight > 0 else "negative", pytest.approx(weight))
    assert got == want and got["good"][0] == "positive" and got["bad"][0] == "negative" and "rare" not in got
    assert tt.polarity(spark.createDataFrame([], "word string, y int"), "y").count() == 0


# ---------------------------------------------------------------- densities, smoother

def test_binned_density_within_its_bound(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 500), rng.normal(6, 0.2, 300), [40.0]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(3)
    for method, factor in (("scott", len(x) ** -0.2), ("silverman", (len(x) * 3 / 4) ** -0.2)):
        h = factor * x.std(ddof=1)
        rows = st.kde_1d(df, "x", 101, method).orderBy("i").collect()
        grid = np.array([r.x for r in rows])
        direct = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
        err = np.abs(np.array([r.density for r in rows]) - direct).max()
        assert err <= 1 / 16 ** 2 / (8 * h * math.sqrt(2 * math.pi))
        assert grid[0] == pytest.approx(x.min() - x.std(ddof=1)) and len(rows) == 101


def test_binned_density_2d_within_its_bound(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 1, (400, 2)) @ np.array([[2.0, 1.5], [0.0, 0.7]]) + [3, -5]
    df = spark.createDataFrame([(float(p), float(q)) for p, q in a], "x double, y double")
    rows = st.kde_2d(df, "x", "y", 30).orderBy("i", "j").collect()
    s = np.cov(a.T) * len(a) ** (-1 / 3)
    inv, height = np.linalg.inv(s), 1 / (2 * math.pi * math.sqrt(np.linalg.det(s)))
    d = np.array([[r.x, r.y] for r in rows])[:, None] - a
    direct = (np.exp(-0.5 * np.einsum("gnp,pq,gnq->gn", d, inv, d)).sum(1)) * height / len(a)
    assert len(rows) == 900
    assert np.abs(np.array([r.density for r in rows]) - direct).max() <= height / 256


def test_density_work_does_not_grow_with_rows(spark):
    """Rows that meet grid points: cells, bounded by the range over the bandwidth."""
    for n in (1000, 20_000):
        df = spark.range(n).select((F.rand(3) * 100).alias("x"))
        s = df.agg(F.stddev_samp("x")).first()[0]
        h = n ** -0.2 * s
        cells = st._shares(df.select((F.col("x") / (h / 16)).alias("f0")), 1).select("c0").distinct().count()
        assert cells <= 100 / (h / 16) + 2


def plain_smooth(x, y, grid, span):
    out = []
    q = max(1, math.floor(span * len(x) + 1e-5))
    for g in grid:
        d = np.abs(x - g)
        h = np.sort(d)[q - 1]
        w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0.0)
        root = np.sqrt(w)
        basis = np.stack([np.ones_like(x), x - g, (x - g) ** 2], 1)
        out.append(np.linalg.lstsq(basis * root[:, None], y * root, rcond=None)[0][0])
    return np.array(out)


@pytest.mark.parametrize("span", [0.75, 0.3])
def test_smoother_equals_a_plain_fit(spark, span):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 60, 300).astype(float)
    y = np.sin(x / 8) * 10 + rng.normal(0, 1, 300)
    df = spark.createDataFrame(list(zip(map(float, x), map(float, y))) + [(None, 1.0), (2.0, None)], "x double, y double")
    rows = st.smooth(df, "x", "y", span, 25).orderBy("i").collect()
    grid = np.array([r.x for r in rows])
    assert np.allclose(grid, np.linspace(x.min(), x.max(), 25))
    assert np.allclose([r.y_fit for r in rows], plain_smooth(x, y, grid, span), atol=1e-6)


def test_smoother_in_buckets(spark):
    rng = np.random.default_rng(5)
    x = rng.random(4000) * 50
    y = x ** 2 / 50 + rng.normal(0, 1, 4000)
    df = spark.createDataFrame(list(zip(map(float, x), map(float, y))), "x double, y double").repartition(4)
    rows = st.smooth(df, "x", "y", 0.5, 20, buckets=200).orderBy("i").collect()
    want = plain_smooth(x, y, np.array([r.x for r in rows]), 0.5)
    assert len(rows) == 20 and np.abs(np.array([r.y_fit for r in rows]) - want).max() < 0.02


def test_smoother_of_few_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "x double, y double")
    assert st.smooth(frame([]), "x", "y").count() == 0
    one = st.smooth(frame([(2.0, 3.0), (2.0, 5.0)]), "x", "y", num=4).collect()
    assert [(r.x, r.y_fit) for r in one] == [(2.0, 4.0)] * 4


# ---------------------------------------------------------------- n-grams

def test_stop_words_do_not_move_the_ngrams(spark):
    """The list is broadcast by its size, before any n-gram is shuffled, and
    n-grams are joined to strings outside of array functions."""
    texts = spark.createDataFrame([("d", "The red fox and 12 red foxes"), ("d", "one"), ("e", None), ("e", "red fox")],
                                  "document string, text string")
    grams = tt.separate(tt.ngrams(texts, 2), "ngram", ["word1", "word2"])
    kept = tt.ngram_parts_without_stop_words(grams, ["word1", "word2"], lexicons.stop_words(spark))
    assert sorted(tuple(r) for r in kept.select("document", "word1", "word2").collect()) == [
        ("d", "12", "red"), ("d", "red", "fox"), ("d", "red", "foxes"), ("e", "red", "fox")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "transform(" not in plan


# ---------------------------------------------------------------- search on edges

def graph_with_hub(n=120, seed=8):
    rng = random.Random(seed)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(30)]  # a long way
    edges += [("hub", f"m{i}") for i in range(n)]
    edges += [(f"m{rng.randrange(n)}", f"m{rng.randrange(n)}") for _ in range(60)]
    edges += [("n30", "m7"), ("m5", "far"), ("alone1", "alone2"), ("n3", None), (None, "n3"), ("n4", "n4"), ("n0", "n1")]
    return edges


def plain_bfs(edges, start):
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    if start not in near:
        return {}, near
    hops, level = {start: 0}, [start]
    while level:
        level = sorted({y for x in level for y in near[x]} - hops.keys())
        hops.update({y: max(hops.values()) + 1 for y in level})
    return hops, near


@pytest.mark.parametrize("hub_edges", [10, 1000])
def test_hops_equal_plain_search(spark, hub_edges):
    edges = graph_with_hub()
    net = nw.network(spark.createDataFrame(edges, "src string, dst string").repartition(3), hub_edges=hub_edges)
    assert net.slots.count() == (1 if hub_edges == 10 else 0)
    if hub_edges == 10:
        assert net.edges.where("src = 'hub'").select("slot").distinct().count() >= 10
    for start in ("n0", "hub", "alone1", "nobody"):
        hops, near = plain_bfs(edges, start)
        want = {(x, h, min((y for y in near[x] if hops[y] == h - 1), default=None)) for x, h in hops.items()}
        assert {(r.node, r.hops, r.parent) for r in nw.hops_from(net, start).collect()} == want


def test_search_aggregates_numbers_in_bounded_tasks(spark, monkeypatch):
    """The smallest neighbour is a hash aggregate (one over names sorts its
    rows), and the edges lie in partitions in proportion to their number."""
    monkeypatch.setattr(nw, "TASK_EDGES", 50)
    edges = graph_with_hub()
    net = nw.network(spark.createDataFrame(edges, "src string, dst string"))
    reached = nw._step(net, nw._start(net, "n0")).groupBy("node").agg(F.min("from"))
    assert "SortAggregate" not in reached._jdf.queryExecution().executedPlan().toString()
    files = net.links.groupBy(F.input_file_name()).count().count()
    assert files >= len(set(edges)) // 100
    assert {(r.src, r.dst) for r in net.edges.collect()} == {
        e for a, b in edges if a is not None and b is not None and a != b for e in ((a, b), (b, a))}


def test_paths_equal_plain_search(spark):
    edges = graph_with_hub()
    net = nw.network(spark.createDataFrame(edges, "src string, dst string"), hub_edges=20)
    for start, goal in (("n0", "far"), ("m1", "m2"), ("n5", "n5"), ("n0", "n1"), ("n0", "alone1"), ("n0", "nobody")):
        hops, near = plain_bfs(edges, start)
        back, _ = plain_bfs(edges, goal)
        want = []
        if goal in hops:
            want = [start]
            while want[-1] != goal:
                want.append(min(y for y in near[want[-1]] if back[y] == back[want[-1]] - 1))
        got = [r.node for r in nw.path_between(net, start, goal).orderBy("step").collect()]
        assert got == want


def test_directed_hops_and_reach(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "src int, dst int")
    net = nw.network(edges, directed=True)
    assert {(r.node, r.hops) for r in nw.hops_from(net, 1, directed=True).collect()} == {(1, 0), (2, 1), (3, 2)}
    value = {r.node: r.value for r in nw.discounted_from(nw.network(edges), 4).collect()}
    assert value == pytest.approx({4: 1.0, 1: 0.99, 2: 0.99 ** 2, 3: 0.99 ** 2})
