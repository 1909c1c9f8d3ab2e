"""Registered model queries.  Fits are seeded; outputs are model
tables or scored rows.  There is no SQL twin for a fitted model, so these are
checked on rows (and by the unit tests against closed forms)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewise.functions import text as tx
from framewise.functions.binning import tenure_group
from framewise.operators import aggregates as agg
from framewise.operators import docmatrix as dm
from framewise.operators import linkage as lk
from framewise.operators import models as ml
from framewise.operators import pairs as pr
from framewise.operators import stats as st
from framewise.operators import verbs as vb
from framewise.plans import catalog as C
from framewise.session import materialize
from framewise.sources import views
from framewise.sources.lexicons import english_stop_words
from framewise.sources.tables import spread, table

MODEL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LABEL = "churn"
TERMS = ["segment", "region", "c_acctbal", "n_orders", "avg_price", "tenure"]
CATEGORICAL = ["segment", "region", "tenure_group"]
NUMERIC = ["c_acctbal", "n_orders", "avg_price", "tenure"]
REGRESSORS = ["c_acctbal", "n_orders", "avg_price", "tenure"]
TARGET = "total_spend"


def model_query(name: str):
    def deco(fn):
        MODEL_QUERIES[name] = fn
        return fn
    return deco


def _features(spark, sf):
    cf = views.customer_features(spark, sf)
    return cf.withColumn("tenure_group", F.coalesce(tenure_group("tenure"), F.lit("none")))


def _split(spark, sf):
    """(train, test), written once: a fit scans its rows many times."""
    s = materialize(C._stratified(spark, sf).withColumn(
        "tenure_group", F.coalesce(tenure_group("tenure"), F.lit("none"))), "split")
    return s.where("is_train").drop("is_train"), s.where("NOT is_train").drop("is_train")


@model_query("logit_coefficients")
def logit_coefficients(spark, sf):
    train, _ = _split(spark, sf)
    return ml.logit_coefficients(train, LABEL, TERMS)


@model_query("logit_anova")
def logit_anova(spark, sf):
    train, _ = _split(spark, sf)
    return ml.logit_anova(train, LABEL, TERMS)


@model_query("logit_scored")
def logit_scored(spark, sf):
    train, test = _split(spark, sf)
    return ml.logit_scored(train, test, LABEL, TERMS).select(
        "c_custkey", F.col(LABEL).alias("actual"), "probability", "predicted")


@model_query("logit_confusion")
def logit_confusion(spark, sf):
    s = logit_scored(spark, sf)
    return agg.confusion_matrix(s, "actual", "predicted")


@model_query("odds_ratios")
def odds_ratios(spark, sf):
    train, _ = _split(spark, sf)
    return ml.odds_ratios(train, LABEL, TERMS)


@model_query("tree_scored")
def tree_scored(spark, sf):
    train, test = _split(spark, sf)
    out = ml.tree_scored(train, test, LABEL, CATEGORICAL)
    return out.select("c_custkey", "actual", "predicted")


@model_query("tree_confusion")
def tree_confusion(spark, sf):
    return agg.confusion_matrix(tree_scored(spark, sf), "actual", "predicted")


@model_query("tree_accuracy")
def tree_accuracy(spark, sf):
    return tree_scored(spark, sf).agg(agg.accuracy("actual", "predicted").alias("accuracy"))


@model_query("chi_square_by_feature")
def chi_square_by_feature(spark, sf):
    return ml.chi_square_by_feature(_features(spark, sf), LABEL, CATEGORICAL)


@model_query("forest_default_confusion_stats")
def forest_default_confusion_stats(spark, sf):
    """The forest before tuning: 500 trees, the square root of the columns a split."""
    train, test = _split(spark, sf)
    out, _, _ = ml.forest_scored(train, test, LABEL, CATEGORICAL, NUMERIC, 500, "sqrt")
    return agg.confusion_stats(out, "actual", "predicted", 0)


@model_query("forest_scored")
def forest_scored(spark, sf):
    train, test = _split(spark, sf)
    out, _, _ = ml.forest_scored(train, test, LABEL, CATEGORICAL, NUMERIC, 200, "2")
    return out.select("c_custkey", "actual", "predicted")


@model_query("forest_confusion_stats")
def forest_confusion_stats(spark, sf):
    return agg.confusion_stats(forest_scored(spark, sf), "actual", "predicted", 0)


@model_query("feature_importance")
def feature_importance(spark, sf):
    train, test = _split(spark, sf)
    _, m, names = ml.forest_scored(train, test, LABEL, CATEGORICAL, NUMERIC, 200, "2")
    return ml.feature_importance(m, names, spark, top=10)


@model_query("forest_error_curve")
def forest_error_curve(spark, sf):
    train, test = _split(spark, sf)
    return ml.forest_error_curve(train, test, LABEL, CATEGORICAL, NUMERIC)


@model_query("forest_tuning")
def forest_tuning(spark, sf):
    train, test = _split(spark, sf)
    return ml.forest_tuning(train, test, LABEL, CATEGORICAL, NUMERIC, trees=200)


def _parts(spark, sf):
    cf = vb.split_random(views.customer_features(spark, sf), ["c_custkey"], 0.8, C.SEED)
    return cf.where("is_train").drop("is_train"), cf.where("NOT is_train").drop("is_train")


@model_query("gbt_scored")
def gbt_scored(spark, sf):
    train, test = _parts(spark, sf)
    out, _ = ml.gbt_scored(train, test, TARGET, REGRESSORS, rounds=100)
    return out.select("c_custkey", TARGET, "predicted")


@model_query("gbt_rmse")
def gbt_rmse(spark, sf):
    s = gbt_scored(spark, sf)
    return s.agg(agg.mse(TARGET, "predicted").alias("mse")).select(
        "mse", F.sqrt("mse").alias("rmse"))


@model_query("gbt_importance")
def gbt_importance(spark, sf):
    train, _ = _parts(spark, sf)
    _, m = ml.gbt_scored(train, train.limit(0), TARGET, REGRESSORS, rounds=100)
    return ml.feature_importance(m, REGRESSORS, spark, top=10)


def _kmeans_summary(df: DataFrame, value: str, k: int) -> DataFrame:
    _, centres = ml.kmeans_1d(df, value, k)
    assigned = st.nearest_centroid(df.where(F.col(value).isNotNull()), value, centres)
    per = assigned.groupBy("code").agg(F.count(F.lit(1)).alias("n"),
                                       F.avg("dist").alias("mean_dist"))
    return centres.join(per, "code").select("code", "center", "n", "mean_dist")


@model_query("kmeans_1d")
def kmeans_1d(spark, sf):
    """Salaries, k = 4: centres, sizes, mean distance per cluster."""
    return _kmeans_summary(views.salaries(spark, sf), "s_acctbal", 4)


@model_query("kmeans_distortion")
def kmeans_distortion(spark, sf):
    """High-value source readings (event_type 'error'), k = 8: distortion =
    mean distance of every observation to its nearest centre."""
    r = views.readings(spark, sf).where(F.col("event_type") == "error")
    _, centres = ml.kmeans_1d(r, "value", 8)
    a = st.nearest_centroid(r.where(F.col("value").isNotNull()), "value", centres)
    return a.agg(F.avg("dist").alias("distortion"), F.count(F.lit(1)).alias("n"))


@model_query("anomaly_flags")
def anomaly_flags(spark, sf):
    """Readings flagged when beyond the 1.5·IQR box of their type, or in a
    k-means (k = 8) cluster holding under 1 % of the rows."""
    r = views.readings(spark, sf).where(F.col("value").isNotNull())
    box = agg.box_stats(r, "value", ["event_type"]).select(
        "event_type", "q1", "q3")
    _, centres = ml.kmeans_1d(r, "value", 8)
    a = st.nearest_centroid(r, "value", centres)
    sizes = a.groupBy("code").agg(F.count(F.lit(1)).alias("_size"))
    total = a.agg(F.count(F.lit(1))).scalar()
    iqr = F.col("q3") - F.col("q1")
    out = (a.join(sizes, "code").join(box, "event_type")
            .withColumn("box_outlier", (F.col("value") < F.col("q1") - 1.5 * iqr) |
                        (F.col("value") > F.col("q3") + 1.5 * iqr))
            .withColumn("small_cluster", F.col("_size") / total < 0.01))
    return out.select("event_id", "event_type", "value", "code", "box_outlier", "small_cluster")


def _doc_words(spark, sf):
    """(document, words): each document's tokens without numbers and stop words."""
    stops = list(english_stop_words())
    d = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return d.select(F.col("doc_id").alias("document"), F.filter(
        tx.tokens(F.coalesce("text", F.lit(""))),
        lambda w: ~tx.is_number(w) & ~w.isin(stops)).alias("words"))


def _doc_terms(spark, sf):
    return dm.doc_terms(_doc_words(spark, sf))


@model_query("doc_kmeans")
def doc_kmeans(spark, sf):
    """k = 3 on each document's distances to all documents, best of 100 random
    starts; its cluster and its distances to the three centres."""
    out = pr.cluster_rows(_doc_terms(spark, sf), 3, restarts=100)
    return out.select("document", "cluster", *[F.col("distances")[i].alias(f"distance_{i}") for i in range(3)])


def _forest(spark, sf):
    nodes, edges = lk.neighbour_graph(_doc_terms(spark, sf))
    return nodes, lk.spanning_forest(edges)[0]


@model_query("doc_hierarchy")
def doc_hierarchy(spark, sf):
    """The merge tree cut into 3 groups."""
    return lk.cut_tree(*_forest(spark, sf), 3)


@model_query("doc_merge_tree")
def doc_merge_tree(spark, sf):
    """(child, document, parent, height): a child is a merge or, with its
    document, a leaf."""
    nodes, forest = _forest(spark, sf)
    tree = lk.merge_tree(forest)
    leaves = nodes.select((-F.col("node")).alias("child"), "document")
    return tree.join(leaves, "child", "left").select("child", "document", "parent", "height")


@model_query("doc_projection")
def doc_projection(spark, sf):
    """Two principal components of the documents' word counts."""
    scores, _ = dm.project(_doc_terms(spark, sf))
    return scores.select("document", F.col("scores")[0].alias("pc1"), F.col("scores")[1].alias("pc2"))


@model_query("vocabulary_index")
def vocabulary_index(spark, sf):
    """Every word with its number and its count."""
    return _doc_terms(spark, sf).vocabulary


def _topics(spark, sf, k):
    dt = _doc_terms(spark, sf)
    return dt, dm.fit_topics(dt, k, seed=C.SEED)


def _top_terms(spark, sf, k):
    """The 10 heaviest words of each of k topics (ties: by word)."""
    best = Window.partitionBy("topic").orderBy(F.desc("beta"), "term")
    return dm.topic_words(*_topics(spark, sf, k)).withColumn("_r", F.row_number().over(best)).where(
        "_r <= 10").drop("_r")


@model_query("lda_top_terms")
def lda_top_terms(spark, sf):
    return _top_terms(spark, sf, 10)


@model_query("lda_top_terms_5")
def lda_top_terms_5(spark, sf):
    return _top_terms(spark, sf, 5)


@model_query("lda_gamma")
def lda_gamma(spark, sf):
    """k = 5 topics: box statistics of the documents' shares by topic."""
    return agg.box_stats(dm.document_topics(*_topics(spark, sf, 5)), "gamma", ["topic"])


@model_query("lda_gamma_10")
def lda_gamma_10(spark, sf):
    """k = 10 topics: every document's share of every topic."""
    return dm.document_topics(*_topics(spark, sf, 10))
