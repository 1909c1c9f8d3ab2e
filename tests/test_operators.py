"""Unit tests on tiny literal frames: edges, ties, NULL order, zero cells,
unreachable goals, and closed forms (numpy) for the statistics."""

import math
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.functions import text as tx
from framewise.functions.binning import tenure_group
from framewise.operators import aggregates as agg
from framewise.operators import graph as gr
from framewise.operators import profile as pf
from framewise.operators import stats as st
from framewise.operators import text as tt
from framewise.operators import verbs as vb
from framewise.operators import windows as wn


def test_tenure_bins_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 12.0, 12.5, 24.0, 60.0, 61.0, -1.0)], "t double")
    got = dict(df.select("t", tenure_group("t").alias("g")).collect())
    assert got == {0.0: "0-12 Month", 12.0: "0-12 Month", 12.5: "12-24 Month",
                   24.0: "12-24 Month", 60.0: "48-60 Month", 61.0: "> 60 Month", -1.0: None}


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 4.0), ("c", 4.0), ("d", 3.0), ("e", None)],
                               "k string, v double")
    assert sorted(r.k for r in vb.top_n_ties(df, 2, "v").collect()) == ["a", "b", "c"]
    g = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("x", 0.5), ("y", 2.0)], "g string, v double")
    assert vb.top_n_ties(g, 1, "v", ["g"]).count() == 3


def test_sort_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, 1.0)], "id int, v double")
    assert [r.id for r in vb.sort_nulls_last(df, "v").collect()] == [3, 2, 1]
    assert [r.id for r in vb.sort_nulls_last(df, ("v", "desc")).collect()] == [2, 3, 1]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "c string")
    assert vb.filter_not_in(df, "c", ["A"]).count() == 2


def test_confusion_matrix_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "a int, p int")
    cells = {(r.actual, r.predicted): r.n for r in agg.confusion_matrix(df, "a", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    s = agg.confusion_stats(df, "a", "p", 0).first()
    assert s.tp + s.fp + s.fn + s.tn == 3


def test_confusion_with_three_labels_and_null(spark):
    rows = [(0, 0), (1, 2), (2, 2), (None, 1), (1, 2)]
    df = spark.createDataFrame(rows, "a int, p int")
    cells = {(r.actual, r.predicted): r.n for r in agg.confusion_matrix(df, "a", "p").collect()}
    assert len(cells) == 16 and sum(cells.values()) == 5
    assert cells[1, 2] == 2 and cells[None, 1] == 1 and cells[0, 2] == 0
    s = agg.confusion_stats(df, "a", "p", 0).first()
    assert s.accuracy == pytest.approx(2 / 5)
    chance = (1 * 1 + 2 * 1 + 1 * 3 + 1 * 0) / 25
    assert s.kappa == pytest.approx((2 / 5 - chance) / (1 - chance))


def test_row_number_global_matches_window(spark):
    rng = np.random.default_rng(7)
    rows = [(("hot" if rng.random() < 0.6 else f"g{rng.integers(5)}"), float(rng.integers(50)), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(7)
    got = wn.row_number_global(df, ["v", "id"], ["g"], name="rn")
    from pyspark.sql import Window
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == \
        sorted(map(tuple, ref.select("id", "rn").collect()))
    glob = wn.row_number_global(df, ["v", "id"], name="rn")
    assert sorted(r.rn for r in glob.collect()) == list(range(1, 3001))


def test_prefix_sum_and_ecdf(spark):
    vals = [3.0, 1.0, 2.0, 2.0, 5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    e = {r.x: r.ecdf for r in wn.ecdf(df, "x").collect()}
    obs = np.array([v for v in vals if v is not None])
    for x, f in e.items():
        assert f == pytest.approx(np.mean(obs <= x))
    g = st.ecdf_grid(df, "x", 100).orderBy("i").collect()
    assert len(g) == 100 and g[-1].ecdf == pytest.approx(1.0)
    for r in g:
        assert r.ecdf == pytest.approx(np.mean(obs <= r.x))


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.exponential(10, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = agg.histogram(df, "x", 10).orderBy("bin").collect()
    counts, _ = np.histogram(x, bins=10)
    assert [r.n for r in h] == list(counts)


def test_histogram_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(4.0, None, 1)] * 3, "a double, b double, c int")
    h = agg.histograms(df, ["a", "b", "c"], 10).collect()
    assert len(h) == 30
    a = sorted((r.bin, r.bin_lo, r.bin_hi, r.n) for r in h if r.column_name == "a")
    counts, edges = np.histogram([4.0] * 3, bins=10)
    assert [r[3] for r in a] == list(counts)
    assert [r[1] for r in a] == pytest.approx(list(edges[:-1]))
    assert all(r.n == 0 and r.bin_lo is None for r in h if r.column_name == "b")


def test_box_stats_match_numpy(spark):
    x = np.array([1, 3, 5, 6, 8, 40, 2, 2, 7, 100], dtype=float)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    b = agg.box_stats(df, "x").first()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    assert (b.q1, b.median, b.q3) == pytest.approx((q1, med, q3))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b.whisker_lo == x[x >= lo].min() and b.whisker_hi == x[x <= hi].max()
    assert b.n_outliers == int(((x < lo) | (x > hi)).sum())


def _kde_numpy(x, grid, factor):
    h = factor * np.std(x, ddof=1)
    return np.array([np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
                     for g in grid])


def test_kde_1d_scott_silverman(spark):
    x = np.array([0.5, 2.25, 2.5, 7.0, 11.0, 11.5])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for method, factor in (("scott", len(x) ** (-1 / 5)),
                           ("silverman", (len(x) * 3 / 4) ** (-1 / 5))):
        out = st.kde_1d(df, "x", 200, method, lo=-4.0, hi=16.0).orderBy("i").collect()
        grid = np.linspace(-4, 16, 200)
        assert [r.x for r in out] == pytest.approx(list(grid))
        h = factor * np.std(x, ddof=1)
        bound = 1 / 16 ** 2 / (8 * h * math.sqrt(2 * math.pi))  # of the binning
        assert [r.density for r in out] == pytest.approx(list(_kde_numpy(x, grid, factor)), abs=bound)


def test_kde_2d_matches_numpy(spark):
    rng = np.random.default_rng(17)
    a, b = rng.multivariate_normal([3.0, -1.0], [[2.0, 0.7], [0.7, 1.5]], size=50).T
    df = spark.createDataFrame([(float(u), float(v)) for u, v in zip(a, b)], "a double, b double")
    out = st.kde_2d(df, "a", "b", 10).collect()
    cov = np.cov(np.vstack([a, b])) * len(a) ** (-2 / 6)
    inv = np.linalg.inv(cov)
    norm = 1 / (len(a) * 2 * math.pi * math.sqrt(np.linalg.det(cov)))
    for r in out[:15]:
        d = np.vstack([r.x - a, r.y - b])
        want = norm * np.exp(-0.5 * np.einsum("ij,ik,kj->j", d, inv, d)).sum()
        assert r.density == pytest.approx(want, abs=norm * len(a) / 256)


def test_ngrams_short_text_gives_none(spark):
    df = spark.createDataFrame([("one",), ("one two three",)], "t string")
    w = df.select(tx.tokens("t").alias("w"))
    got = w.select(tx.ngrams("w", 2).alias("g")).collect()
    assert [r.g for r in got] == [[], ["one two", "two three"]]


def test_clean_text_chain(spark):
    df = spark.createDataFrame([("The runners/walkers @ 42 parks | Running!",)], "t string")
    from framewise.sources.lexicons import english_stop_words
    got = tt.clean_text(df, english_stop_words(), text="t").first().clean
    assert got == "runnerswalk park run"


def test_splits_hold_big_keys_and_null_labels(spark):
    df = spark.range(10_000_000_000, 10_000_001_000).withColumnRenamed("id", "k")
    r = vb.split_random(df, ["k"], 0.8).groupBy("is_train").count().collect()
    assert sum(x["count"] for x in r) == 1000
    assert abs({x.is_train: x["count"] for x in r}[True] - 800) < 60
    y = F.when(F.col("k") % 3 > 0, F.col("k") % 3)
    s = vb.split_stratified(df.withColumn("y", y), "y", ["k"], 0.7)
    assert s.count() == 1000
    shares = s.groupBy("y").agg(F.avg(F.col("is_train").cast("double")).alias("p")).collect()
    assert {x.y for x in shares} == {None, 1, 2}
    assert all(abs(x.p - 0.7) < 0.01 for x in shares)
    assert vb.sample_n(df, 5, ["k"]).count() == 5


def test_limit_by_count_with_ties_and_nulls(spark):
    prices = [3.0, 1.0, None, 1.0, 2.0, 2.0, 2.0, None]
    df = spark.createDataFrame(list(enumerate(prices)), "id int, p double")
    order = sorted(range(8), key=lambda i: (prices[i] is None, prices[i] or 0, i))
    for k in range(10):
        got = vb.limit_by_count(df, df.sparkSession.range(k), "p", ["id"]).collect()
        assert sorted(r.id for r in got) == sorted(order[:k]), k


def test_null_groups_are_kept(spark):
    rows = [("a", 1.0, 1), ("a", 2.0, 2), (None, 5.0, 3), (None, 7.0, 4), ("e", None, 5)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    n = wn.row_number_global(df, ["id"], ["g"], name="rn", size="n").collect()
    assert {(r.id, r.rn, r.n) for r in n} == {(1, 1, 2), (2, 2, 2), (3, 1, 2), (4, 2, 2), (5, 1, 1)}
    q = {r.g: r.q50 for r in agg.quantiles(df, "v", [0.5], ["g"]).collect()}
    assert q == {"a": 1.5, None: 6.0}
    assert {r.g for r in agg.box_stats(df, "v", ["g"]).collect()} == {"a", None}
    d = {r.id: r.u for r in wn.distinct_over_group(df, "g", "v", "u").collect()}
    assert d == {1: 2, 2: 2, 3: 2, 4: 2, 5: 0}
    c = {r.id: r.s for r in wn.cumsum_by_group(df.na.fill(0.0, ["v"]), "g", ["id"], "v", "s").collect()}
    assert c == {1: 1.0, 2: 3.0, 3: 5.0, 4: 12.0, 5: 0.0}
    from framewise.operators import text as tt
    counts = spark.createDataFrame([("d", "x", 1), ("d", None, 3), (None, "x", 2)],
                                   "document string, word string, n long")
    assert tt.tf_idf(counts).count() == 3
    t = vb.top_n_ties(df, 1, "v", ["g"])
    assert {(r.g, r.v) for r in t.collect()} == {("a", 2.0), (None, 7.0)}


def test_describe_extreme_values(spark):
    rows = [(1e-11, 1e29, None, 1), (3e-11, 1e29, None, 3), (None, 1e29, None, 2)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int")
    d = {r.column_name: r for r in pf.describe_numeric(df).collect()}
    assert d["a"].mean == pytest.approx(2e-11) and d["a"]["count"] == 2
    assert d["b"].mean == 1e29 and d["b"].q50 == 1e29
    assert d["c"]["count"] == 0 and d["c"].mean is None and d["c"].q25 is None
    assert (d["d"].q25, d["d"].q50, d["d"].q75) == (1.5, 2.0, 2.5)


def test_any_missing_of_every_type(spark):
    df = spark.createDataFrame([("x", float("nan"), 1)], "s string, v double, i int")
    assert [pf.any_missing(df, c).first()[0] for c in ("s", "v", "i")] == [False, True, False]


def test_nan_becomes_null_at_load(spark, tmp_path):
    from framewise.sources.tables import table
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "event_id int, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    t = table(spark, str(tmp_path), "events")
    assert {r.event_id: r.value for r in t.collect()} == {1: None, 2: 3.0}
    assert pf.describe_numeric(t, ["value"]).first().mean == 3.0


def test_constant_columns(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    t = st.trend_line(df, "x", "y", 4).collect()
    assert len(t) == 1 and t[0].y_mean == 2.0 and t[0].y_fit == 2.0 and t[0].n == 2
    t = st.trend_line(df, "x", "y", 4, decimals=2).collect()
    assert len(t) == 1 and t[0].y_fit == 2.0
    assert all(r.density is None for r in st.kde_1d(df, "x", 5).collect())
    assert all(r.density is None for r in st.kde_2d(df, "x", "y", 3).collect())
    assert st.ecdf_grid(df, "x", 5).agg(F.max("ecdf")).first()[0] == 1.0


def test_reorder_within_takes_an_aggregate(spark):
    from framewise.operators import text as tt
    df = spark.createDataFrame([("a", "d", 1.0), ("a", "d", 4.0)], "w string, g string, v double")
    assert tt.reorder_within(df, "w", "v", "g", "l", fun=F.max).first().l_key == 4.0


def test_doc_term_triples(spark):
    from framewise.operators import text as tt
    wc = spark.createDataFrame([("a", "y", 2), ("a", "x", 1), ("b", "y", 1), ("b", None, 3)],
                               "document string, word string, count long")
    got = {(r.document, r.term_id, r.term, r.n) for r in tt.doc_term_matrix(wc).collect()}
    assert got == {("a", 2, "y", 2), ("a", 1, "x", 1), ("b", 2, "y", 1)}


def test_percent_share_sums_to_100(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "u string, v string")
    tot = agg.percent_share(df, ["u", "v"]).groupBy("variable").agg(F.sum("pct").alias("s"))
    assert all(r.s == pytest.approx(100.0) for r in tot.collect())


def _bfs_python(open_cells, start):
    dist = {start: 0}
    q = deque([start])
    while q:
        r, c = q.popleft()
        for dr, dc in ((1, 0), (-1, 0), (0, 1), (0, -1)):
            n = (r + dr, c + dc)
            if n in open_cells and n not in dist:
                dist[n] = dist[(r, c)] + 1
                q.append(n)
    return dist


def test_bfs_hops_path_and_reach(spark):
    rng = np.random.default_rng(11)
    rows = [(r, c, bool(rng.random() < 0.25) and (r, c) not in ((1, 1), (7, 8)))
            for r in range(9) for c in range(10)]
    cells = spark.createDataFrame(rows, "r long, c long, wall boolean")
    opened = {(r, c) for r, c, w in rows if not w}
    want = _bfs_python(opened, (1, 1))
    edges = gr.grid_edges(cells)
    h, rounds = gr.bfs(edges, cells, (1, 1), side=4)  # nine tiles
    got = {(r.r, r.c): r.hops for r in h.collect()}
    assert got == want and rounds > 1
    assert {(r.r, r.c): r.hops for r in gr.bfs(edges, cells, (1, 1))[0].collect()} == want
    goal = gr.farthest(h)
    assert want[goal] == max(want.values())
    up = gr.ascent_path(edges, h, goal).orderBy("step").collect()
    assert (up[0].r, up[0].c) == goal and [want[r.r, r.c] for r in up] == list(range(want[goal], -1, -1))
    path = gr.shortest_path(h, goal).orderBy("step").collect()
    assert len(path) == want[goal] + 1 > 5
    assert (path[0].r, path[0].c) == (1, 1) and (path[-1].r, path[-1].c) == goal
    for a, b in zip(path, path[1:]):
        assert abs(a.r - b.r) + abs(a.c - b.c) == 1
    reach = {(r.r, r.c): r.value for r in gr.discounted_reach(cells, h, goal).collect()}
    limit = want.get(goal, 10 ** 9)
    for cell, v in reach.items():
        d = want.get(cell)
        assert v == pytest.approx(0.99 ** d if d is not None and d <= limit else 0.0)


def test_unreachable_goal_gives_empty_path(spark):
    rows = [(0, 0, False), (0, 1, True), (0, 2, False)]
    cells = spark.createDataFrame(rows, "r long, c long, wall boolean")
    h, _ = gr.bfs(gr.grid_edges(cells), cells, (0, 0))
    assert gr.shortest_path(h, (0, 2)).count() == 0
    assert gr.bfs(gr.grid_edges(cells), cells, (0, 1))[0].count() == 0  # starts in a wall


@pytest.mark.parametrize("start", [(0, 1), (5, 5)])  # a wall; a cell that is not there
def test_grid_without_an_open_start(spark, start):
    rows = [(0, 0, False), (0, 1, True), (0, 2, False)]
    cells = spark.createDataFrame(rows, "r long, c long, wall boolean")
    edges = gr.grid_edges(cells)
    h, _ = gr.bfs(edges, cells, start)
    goal = gr.farthest(h)
    assert goal is None
    assert gr.shortest_path(h, goal).collect() == [] and gr.ascent_path(edges, h, goal).collect() == []
    assert sorted(map(tuple, gr.discounted_reach(cells, h, goal).collect())) == [
        (0, 0, 0.0), (0, 1, 0.0), (0, 2, 0.0)]


def test_nearest_centroid_ties_take_smallest_code(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, None)], "id int, x double")
    book = spark.createDataFrame([(0, 4.0), (1, 6.0), (2, 0.5)], "code int, center double")
    got = {r.id: (r.code, r.dist) for r in st.nearest_centroid(df, "x", book).collect()}
    assert got == {1: (0, 1.0), 2: (2, 0.5), 3: (None, None)}


def test_quantiles_agree_with_numpy_under_skew(spark):
    rng = np.random.default_rng(5)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.integers(4)}",
             float(np.round(rng.gamma(2.0, 10.0), 1))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    q = agg.quantiles(df, "v", [0.1, 0.25, 0.5, 0.85], ["g"]).collect()
    for r in q:
        x = np.array([v for g, v in rows if g == r.g])
        want = np.percentile(x, [10, 25, 50, 85])
        assert [r.q10, r.q25, r.q50, r.q85] == pytest.approx(list(want), rel=1e-12)


def test_scratch_tables_are_released(spark):
    import os

    from framewise import session
    t = session.materialize(spark.range(3), "probe")
    path = t.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    session.release_scratch(spark)
    assert not os.path.exists(path)
