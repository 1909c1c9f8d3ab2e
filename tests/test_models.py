"""Model helpers: closed forms and repeatability."""

import math

import pytest
from pyspark.sql import functions as F

from framewise.operators import models as ml
from framewise.plans import models_catalog as M


@pytest.mark.parametrize("x,k,p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05),
                                   (0.5, 3, 0.9188914116), (20.0, 4, 0.0004993992)])
def test_chi2_upper_tail(x, k, p):
    assert ml._chi2_sf(x, k) == pytest.approx(p, rel=1e-6)


@pytest.mark.parametrize("name", sorted(M.MODEL_QUERIES))
def test_model_query(spark, sf_small, name):
    df = M.MODEL_QUERIES[name](spark, sf_small)
    rows = df.collect()
    assert rows
    check = CHECKS.get(name)
    if check:
        check(spark, sf_small, rows)


def _anova(spark, sf, rows):
    """The first row is the intercept-only model, in closed form."""
    train, _ = M._split(spark, sf)
    n, p = train.agg(F.count(F.lit(1)), F.avg("churn")).first()
    assert rows[0].resid_df == n - 1
    assert rows[0].resid_dev == pytest.approx(-2 * n * (p * math.log(p) + (1 - p) * math.log(1 - p)))
    assert all(a.resid_dev >= b.resid_dev for a, b in zip(rows, rows[1:]))


def _chi_square(spark, sf, rows):
    f = M._features(spark, sf)
    for r in rows:
        cells = f.groupBy(r.feature, "churn").count().collect()
        total = sum(c["count"] for c in cells)
        by = lambda k, v: sum(c["count"] for c in cells if c[k] == v)
        levels = {c[r.feature] for c in cells}
        seen = {(c[r.feature], c.churn): c["count"] for c in cells}
        want = sum((seen.get((a, b), 0) - by(r.feature, a) * by("churn", b) / total) ** 2
                   / (by(r.feature, a) * by("churn", b) / total) for a in levels for b in (0, 1))
        assert r.statistic == pytest.approx(want) and r.dof == len(levels) - 1


def _sizes(spark, sf, rows):
    from framewise.sources import views
    assert sum(r.n for r in rows) == views.salaries(spark, sf).count() and len(rows) == 4


def _matrix(spark, sf, rows):
    assert sum(r.n for r in rows) == M._split(spark, sf)[1].count()


CHECKS = {"logit_anova": _anova, "chi_square_by_feature": _chi_square, "kmeans_1d": _sizes,
          "logit_confusion": _matrix, "tree_confusion": _matrix}


def test_logit_recovers_sign(spark):
    rows = [(i, float(i % 10), 1 if (i % 10) > 4 else 0) for i in range(200)]
    rows += [(1000 + i, 4.5, i % 2) for i in range(40)]  # overlap so the fit is finite
    df = spark.createDataFrame(rows, "id long, x double, y int")
    co = {r.term: r.estimate for r in ml.logit_coefficients(df, "y", ["x"]).collect()}
    assert co["x"] > 0


def test_logit_equals_a_plain_fit(spark):
    """Coefficients, errors and odds ratios against Newton's method on the
    dense matrix, with a categorical term."""
    import numpy as np

    rng = np.random.default_rng(6)
    x, kind = rng.normal(0, 1, 400), rng.choice(["a", "b", "c"], 400)
    eta = 0.4 + 1.1 * x - 0.8 * (kind == "b") + 0.3 * (kind == "c")
    y = (rng.random(400) < 1 / (1 + np.exp(-eta))).astype(int)
    df = spark.createDataFrame([(int(a), float(b), str(c)) for a, b, c in zip(y, x, kind)], "y int, x double, kind string")
    got = {r.term: r for r in ml.logit_coefficients(df, "y", ["x", "kind"]).collect()}
    levels = sorted({t.split("_")[-1] for t in got if t.startswith("kind")})
    design = np.stack([np.ones(400), x, *[(kind == v) for v in levels]], 1).astype(float)
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = design.T @ (design * (p * (1 - p))[:, None])
        beta += np.linalg.solve(hessian, design.T @ (y - p))
    error = np.sqrt(np.diag(np.linalg.inv(hessian)))
    terms = ["(Intercept)", "x", *[f"kind_{v}" for v in levels]]
    assert set(terms) == set(got)
    odds = {r.term: r for r in ml.odds_ratios(df, "y", ["x", "kind"]).collect()}
    for t, b, e in zip(terms, beta, error):
        assert got[t].estimate == pytest.approx(b, abs=1e-5) and got[t].std_error == pytest.approx(e, rel=1e-4)
        assert odds[t].odds_ratio == pytest.approx(math.exp(b), rel=1e-4)
        assert odds[t].ci_low == pytest.approx(math.exp(b - 1.959964 * e), rel=1e-3)
        assert odds[t].ci_high == pytest.approx(math.exp(b + 1.959964 * e), rel=1e-3)


def test_fits_read_the_split_from_one_written_table(spark, sf_small):
    """The joins and the split behind a fit are worked out once, not per scan."""
    from framewise.plans import catalog as C
    from framewise.plans import models_catalog as mc
    train, test = mc._split(spark, sf_small)
    assert {f.rsplit("/", 2)[1].startswith("split-") for df in (train, test) for f in df.inputFiles()} == {True}
    assert "Join" not in train._jdf.queryExecution().optimizedPlan().toString()
    want = {r.c_custkey: r.is_train for r in C._stratified(spark, sf_small).select("c_custkey", "is_train").collect()}
    got = {r.c_custkey: on for df, on in ((train, True), (test, False)) for r in df.select("c_custkey").collect()}
    assert got == want and train.count() + test.count() == len(want)
