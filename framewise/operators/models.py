"""Models on ``pyspark.ml``: logistic regression tables, trees, forests,
boosted trees; exact k-means on one column.  Topics, projections and clusters
of documents are in ``docmatrix`` and ``linkage``.

Fitting is MLlib's distributed work (tree aggregates over partitions); what
reaches the driver is model metadata only (coefficients, importances,
centres, topic matrices), bounded by the number of features or topics.
Every output is a DataFrame built from that metadata or from ``transform``.
Algorithms that differ from their single-machine namesakes are marked in
their docstrings.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.operators.windows import prefix_sum
from framewise.session import materialize


def _rows(spark, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# --- logistic regression -----------------------------------------------------

def fit_logit(df: DataFrame, label: str, terms: Sequence[str]):
    formula = f"{label} ~ {' + '.join(terms)}"
    rf = RFormula(formula=formula, featuresCol="features", labelCol="label")
    prepared = rf.fit(df)
    data = prepared.transform(df)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50,
                                      featuresCol="features", labelCol="label")
    model = glr.fit(data)
    names = [a["name"] for a in sorted(
        data.schema["features"].metadata["ml_attr"]["attrs"].get("numeric", []) +
        data.schema["features"].metadata["ml_attr"]["attrs"].get("binary", []),
        key=lambda a: a["idx"])]
    return prepared, model, names


def logit_coefficients(df: DataFrame, label: str, terms: Sequence[str]) -> DataFrame:
    """(term, estimate, std_error, z_value, p_value) plus deviance / AIC rows."""
    _, model, names = fit_logit(df, label, terms)
    s = model.summary
    est = [model.intercept] + list(model.coefficients)
    terms_ = ["(Intercept)"] + names
    se, z, p = s.coefficientStandardErrors, s.tValues, s.pValues
    # the summary lists the intercept last
    se = [se[-1]] + se[:-1]
    z = [z[-1]] + z[:-1]
    p = [p[-1]] + p[:-1]
    rows = [(t, float(e), float(a), float(b), float(c))
            for t, e, a, b, c in zip(terms_, est, se, z, p)]
    schema = "term string, estimate double, std_error double, z_value double, p_value double"
    return _rows(df.sparkSession, rows, schema)


def logit_anova(df: DataFrame, label: str, terms: Sequence[str]) -> DataFrame:
    """Sequential deviance table: terms added in order; chi-square p-value.

    Each row is a fitted nested model (one distributed fit per term)."""
    rows = []
    prev_dev, prev_df = None, None
    for k in range(0, len(terms) + 1):
        if k == 0:  # intercept-only model in closed form: p = mean(label)
            data = df.select(F.col(label).cast("double").alias("label"))
            n, pbar = data.agg(F.count(F.lit(1)), F.avg("label")).first()
            dev = -2 * n * (pbar * math.log(pbar) + (1 - pbar) * math.log(1 - pbar))
            resid_df = n - 1
            rows.append(("NULL", None, None, resid_df, float(dev), None))
        else:
            _, model, _ = fit_logit(df, label, terms[:k])
            s = model.summary
            dev, resid_df = float(s.deviance), int(s.residualDegreeOfFreedom)
            d_df = prev_df - resid_df
            d_dev = prev_dev - dev
            p = _chi2_sf(d_dev, d_df) if d_df > 0 else None
            rows.append((terms[k - 1], int(d_df), float(d_dev), resid_df, dev, p))
        prev_dev, prev_df = dev, resid_df
    schema = ("term string, df int, deviance double, resid_df int, resid_dev double, "
              "p_value double")
    return _rows(df.sparkSession, rows, schema)


def _chi2_sf(x: float, k: int) -> float:
    """Upper tail of the chi-square distribution (regularised gamma Q(k/2, x/2))."""
    a, z = k / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    if z < a + 1:  # series for P, then Q = 1 - P
        term = total = 1.0 / a
        n = a
        for _ in range(500):
            n += 1
            term *= z / n
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b = z + 1 - a  # continued fraction for Q
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h


def logit_scored(train: DataFrame, test: DataFrame, label: str, terms: Sequence[str],
                 threshold: float = 0.5) -> DataFrame:
    """Test rows with probability and 0/1 prediction (probability > threshold)."""
    prepared, model, _ = fit_logit(train, label, terms)
    scored = model.transform(prepared.transform(test))
    return scored.select(*test.columns, F.col("prediction").alias("probability"),
                         (F.col("prediction") > threshold).cast("int").alias("predicted"))


def odds_ratios(df: DataFrame, label: str, terms: Sequence[str]) -> DataFrame:
    """exp(coefficient) with a Wald 95 % interval (not profile likelihood)."""
    co = logit_coefficients(df, label, terms)
    z = 1.959963984540054
    return co.select("term", F.exp("estimate").alias("odds_ratio"),
                     F.exp(F.col("estimate") - z * F.col("std_error")).alias("ci_low"),
                     F.exp(F.col("estimate") + z * F.col("std_error")).alias("ci_high"))


# --- trees and forests -----------------------------------------------------------

def _classifier_data(df: DataFrame, label: str, categorical: Sequence[str],
                     numeric: Sequence[str]):
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in categorical]
    va = VectorAssembler(inputCols=[f"{c}_ix" for c in categorical] + list(numeric),
                         outputCol="features", handleInvalid="keep")
    lab = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    return Pipeline(stages=[*idx, va, lab])


def tree_scored(train: DataFrame, test: DataFrame, label: str, categorical: Sequence[str],
                numeric: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """CART tree (not a conditional-inference tree): test rows with prediction."""
    prep = _classifier_data(train, label, categorical, numeric).fit(train)
    m = DecisionTreeClassifier(maxDepth=5, seed=seed, maxBins=64).fit(prep.transform(train))
    out = m.transform(prep.transform(test))
    return out.select(*test.columns, F.col("label").cast("int").alias("actual"),
                      F.col("prediction").cast("int").alias("predicted"))


def chi_square_by_feature(df: DataFrame, label: str, categorical: Sequence[str]) -> DataFrame:
    """Chi-square association of each categorical column with the label: the
    test a conditional-inference tree uses to choose its splits."""
    prep = _classifier_data(df, label, categorical, []).fit(df)
    r = ChiSquareTest.test(prep.transform(df), "features", "label").first()
    rows = [(c, float(r.statistics[i]), int(r.degreesOfFreedom[i]), float(r.pValues[i]))
            for i, c in enumerate(categorical)]
    return _rows(df.sparkSession, rows,
                 "feature string, statistic double, dof int, p_value double")


def forest_scored(train: DataFrame, test: DataFrame, label: str, categorical: Sequence[str],
                  numeric: Sequence[str], num_trees: int = 200, per_split: str = "2",
                  seed: int = 42):
    prep = _classifier_data(train, label, categorical, numeric).fit(train)
    m = RandomForestClassifier(numTrees=num_trees, featureSubsetStrategy=per_split,
                               seed=seed, maxBins=64).fit(prep.transform(train))
    out = m.transform(prep.transform(test)).select(
        *test.columns, F.col("label").cast("int").alias("actual"),
        F.col("prediction").cast("int").alias("predicted"))
    names = list(categorical) + list(numeric)
    return out, m, names


def feature_importance(model, names: Sequence[str], spark, top: int = 10) -> DataFrame:
    imp = model.featureImportances.toArray()
    rows = sorted(((n, float(v)) for n, v in zip(names, imp)), key=lambda t: (-t[1], t[0]))
    return _rows(spark, rows[:top], "feature string, importance double")


def forest_error_curve(train, test, label, categorical, numeric, trees=(10, 25, 50, 100, 200),
                       per_split="2", seed=42) -> DataFrame:
    """Held-out error for several forest sizes (stands in for out-of-bag error)."""
    rows = []
    for t in trees:
        out, _, _ = forest_scored(train, test, label, categorical, numeric, t, per_split, seed)
        err = out.agg(F.avg((F.col("actual") != F.col("predicted")).cast("double"))).first()[0]
        rows.append((int(t), float(err)))
    return _rows(train.sparkSession, rows, "num_trees int, error double")


def forest_tuning(train, test, label, categorical, numeric, start: int = 2,
                  step_factor: float = 0.5, improve: float = 0.05, trees: int = 200,
                  seed: int = 42) -> DataFrame:
    """Columns-per-split search: step the value by ``step_factor`` both ways
    from ``start`` while the held-out error improves by at least ``improve``."""
    p = len(categorical) + len(numeric)

    def err(m):
        out, _, _ = forest_scored(train, test, label, categorical, numeric, trees, str(m), seed)
        return float(out.agg(F.avg((F.col("actual") != F.col("predicted")).cast("double")))
                     .first()[0])

    seen = {start: err(start)}
    for direction in (1.0 / step_factor, step_factor):
        cur = start
        while True:
            nxt = max(1, min(p, int(round(cur * direction))))
            if nxt == cur or nxt in seen:
                break
            seen[nxt] = err(nxt)
            if seen[cur] == 0 or (seen[cur] - seen[nxt]) / seen[cur] < improve:
                break
            cur = nxt
    rows = sorted((int(k), v) for k, v in seen.items())
    return _rows(train.sparkSession, rows, "per_split int, error double")


def gbt_scored(train: DataFrame, test: DataFrame, label: str, features: Sequence[str],
               rounds: int = 100, seed: int = 42):
    """Boosted regression trees (first-order, Spark's GBT; no second-order
    regularisation): 100 rounds, step 0.1, depth 3, row sample 0.8."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    gbt = GBTRegressor(labelCol=label, maxIter=rounds, stepSize=0.1, maxDepth=3,
                       subsamplingRate=0.8, featureSubsetStrategy="all",
                       minInstancesPerNode=1, seed=seed)
    m = gbt.fit(va.transform(train))
    out = m.transform(va.transform(test)).select(*test.columns,
                                                  F.col("prediction").alias("predicted"))
    return out, m


# --- clustering ----------------------------------------------------------------

#: Distinct values that the exact method takes as they are; more go into so many bins of equal counts.
KMEANS_BINS = 8192


def _best_partition(n: np.ndarray, s: np.ndarray, k: int) -> list[int]:
    """Where the k stretches of least squared error start: values in order
    with counts ``n`` and sums ``s``, by divide and conquer over the last
    start (it never moves back when the end moves on)."""
    cn, cs = (np.concatenate([[0.0], np.cumsum(x)]) for x in (n, s))

    def gain(i, j):  # of the stretch i..j-1: squared sum over count, to be made as large as possible
        return (cs[j] - cs[i]) ** 2 / (cn[j] - cn[i])

    size = len(n)
    best, cuts = gain(0, np.arange(1, size + 1)), []
    best = np.concatenate([[0.0], best])
    for layer in range(2, k + 1):
        new, cut = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64)
        todo = [(layer, size, layer - 1, size - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            starts = np.arange(first, min(mid - 1, last) + 1)
            total = best[starts] + gain(starts, mid)
            at = int(total.argmax())
            new[mid], cut[mid] = total[at], starts[at]
            todo += [(lo, mid - 1, first, int(starts[at])), (mid + 1, hi, int(starts[at]), last)]
        best = new
        cuts.append(cut)
    out, end = [], size
    for cut in reversed(cuts):
        end = int(cut[end])
        out.append(end)
    return [0, *reversed(out)]


def kmeans_1d(df: DataFrame, value: str, k: int, bins: int = KMEANS_BINS):
    """k-means on one column: (cost, centres frame (code, center)), the
    optimum over all partitions; with fewer distinct values than ``k``, as
    many centres.

    Equal values are merged.  Up to ``bins`` distinct values the partition of
    the ordered values is optimal.  Beyond that a running total of the counts
    deals them into bins of equal counts (at most n / bins rows, but for a
    value that alone has more), whose exact sums are partitioned: for each
    border between two centres c and d the cost may exceed the optimum by
    2 (d - c) w m, w and m being the width and the rows of the bin that the
    border falls into.  Scans of the merged values then move the centres to
    the means of their nearest values while the cost falls.
    """
    spark = df.sparkSession
    v = F.col(value).cast("double")
    counts = materialize(df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n")), "values")
    shift = counts.agg(F.sum(F.col("v") * F.col("n")) / F.sum("n")).first()[0] or 0.0  # smaller numbers cancel less
    if counts.count() > bins:
        upto = prefix_sum(counts, ["v"], "n", "upto", total="total")
        place = F.expr(f"((upto - n) * {bins}) div total")
    else:
        upto, place = counts, F.col("v")
    rows = upto.groupBy(place.alias("place")).agg(
        F.min("v").alias("lo"), F.sum("n").alias("n"), F.sum((F.col("v") - shift) * F.col("n")).alias("s")).toArrow()
    order = np.argsort(rows["lo"].to_numpy())  # at most bins + 1 rows
    n, s = (rows[c].to_numpy().astype(np.float64)[order] for c in ("n", "s"))
    if not len(n):
        return 0.0, _rows(spark, [], "code int, center double")
    starts = _best_partition(n, s, min(k, len(n)))
    centres = np.add.reduceat(s, starts) / np.add.reduceat(n, starts) + shift
    cost = math.inf
    while True:
        near = F.array_min(F.array(*[F.struct(((F.col("v") - c) * (F.col("v") - c)).alias("d"), F.lit(i).alias("code"))
                                     for i, c in enumerate(map(float, centres))]))
        got = counts.select("v", "n", near.alias("b")).groupBy("b.code").agg(
            F.sum("n").alias("n"), F.sum((F.col("v") - shift) * F.col("n")).alias("s"),
            F.sum(F.col("b.d") * F.col("n")).alias("cost")).collect()  # k rows
        now = sum(r.cost for r in got)
        if now >= cost * (1 - 1e-12):
            break
        cost, kept = now, centres.copy()
        for r in got:
            centres[r.code] = r.s / r.n + shift
    return cost, _rows(spark, [(i, float(c)) for i, c in enumerate(sorted(kept))], "code int, center double")
