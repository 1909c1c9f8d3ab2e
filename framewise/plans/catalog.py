"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the given tables (or views Spark derives from them) in
full.  Floating results are rounded to 6 decimals at the very end so the
SQL oracle can be compared value for value; the library operators
themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.functions import text as tx
from framewise.functions.binning import tenure_group
from framewise.operators import aggregates as agg
from framewise.operators import graph as gr
from framewise.operators import network as nw
from framewise.operators import profile as pf
from framewise.operators import stats as st
from framewise.operators import text as tt
from framewise.operators import verbs as vb
from framewise.operators import windows as wn
from framewise.sources import files, generators, lexicons, views
from framewise.session import materialize, scratch_path
from framewise.sources.tables import SCHEMAS, register_views, table

# Parameters of the registered queries (stand-ins for the reference's own).
YEAR = 2000                 # the "latest full year" of country_year
LIFE_EXP_OVER = 45.0        # flag threshold on the stand-in life expectancy
COUNTRIES = ("NATION_3", "NATION_7")
HIGH_VALUE = 250.0          # readings: high-value threshold
TOP_COUNTRIES = 10
TOP_VARIETIES = 10
TOP_GDP = 5
SALARY_FIXES = {4: 120, 9: 75}  # supplier key: value entered by mistake
TOP_N = 15
QUANTILE = 0.85
SEED = 1234
START = (1, 1)
DECIMALS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(F.col(f.name), DECIMALS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- 2.1 scans, sources, sinks ---------------------------------------------------

@query("scan_csv")
def scan_csv(spark, sf):
    c = table(spark, sf, "customer")
    path = files.write_csv(c, scratch_path(spark, "customer-csv"))
    return rounded(files.read_csv(spark, path, schema=SCHEMAS["customer"]))


@query("scan_csv_inferred")
def scan_csv_inferred(spark, sf):
    """CSV whose types are inferred from the text."""
    path = files.write_csv(table(spark, sf, "customer"), scratch_path(spark, "customer-csv"))
    c = files.read_csv(spark, path)
    return rounded(c.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                            "c_nationkey", "c_acctbal", "c_mktsegment",
                            F.lit(",".join(t for _, t in c.dtypes)).alias("types")))


@query("scan_parquet")
def scan_parquet(spark, sf):
    register_views(spark, sf)
    return spark.sql("""
        SELECT n.n_nationkey, n.n_name, r.r_name
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")


@query("scan_doc_folder")
def scan_doc_folder(spark, sf):
    path = files.write_doc_folder(views.pages_text(spark, sf), "document", "text", "docs")
    d = files.read_doc_folder(spark, path)
    return d.groupBy(F.col("folder").alias("document")).agg(
        F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@query("dim_stop_words")
def dim_stop_words(spark, sf):
    toks = tt.tokenize(views.pages_text(spark, sf))
    used = toks.join(lexicons.stop_words(spark), "word", "left_semi")
    return tt.count_by(used, ["word"])


@query("typed_literals")
def typed_literals(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(
        "n_nationkey",
        F.lit(2.5).alias("ratio"),
        F.lit("2001-06-30").cast("timestamp_ntz").alias("seen"),
        F.lit(0.25).cast("float").alias("weight"),
        F.lit(9).cast("int").alias("rank"),
        F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd").alias("parity"),
        F.lit("note").alias("remark"))


@query("sink_roundtrip")
def sink_roundtrip(spark, sf):
    r = views.readings(spark, sf)
    return rounded(files.csv_roundtrip(r, "readings-na", na="NA"))


@query("date_spine")
def date_spine(spark, sf):
    return generators.daily_counts(table(spark, sf, "orders"), "o_orderdate")


@query("int_range")
def int_range(spark, sf):
    o = table(spark, sf, "orders")
    return generators.int_range_counts(o, F.year("o_orderdate")).withColumnRenamed("k", "year")


@query("grid_points")
def grid_points(spark, sf):
    return rounded(generators.grid_points(table(spark, sf, "events"), "value", 100))


# --- 2.2 profiling ------------------------------------------------------------------

@query("profile_shape")
def profile_shape(spark, sf):
    return pf.shape(table(spark, sf, "lineitem"))


@query("profile_types")
def profile_types(spark, sf):
    return pf.column_types(table(spark, sf, "lineitem"))


@query("head_n")
def head_n(spark, sf):
    return rounded(views.country_year(spark, sf).orderBy("country", "year").limit(6))


@query("tail_n")
def tail_n(spark, sf):
    return rounded(pf.tail_rows(views.country_year(spark, sf), 6, ["country", "year"]))


@query("describe_numeric")
def describe_numeric(spark, sf):
    return rounded(pf.describe_numeric(table(spark, sf, "lineitem")))


@query("describe_categorical")
def describe_categorical(spark, sf):
    return pf.describe_categorical(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("null_counts")
def null_counts(spark, sf):
    return pf.null_counts(views.readings(spark, sf))


@query("any_missing")
def any_missing(spark, sf):
    return pf.any_missing(views.readings(spark, sf), "value")


@query("low_cardinality")
def low_cardinality(spark, sf):
    return pf.low_cardinality(views.labelled_docs(spark, sf), below=10)


@query("value_counts")
def value_counts(spark, sf):
    # the threshold is above the injected NULL value, so it can run on the raw column
    r = views.readings(spark, sf, where=F.col("value") >= HIGH_VALUE)
    return pf.value_counts(r, "event_type")


@query("min_max")
def min_max(spark, sf):
    s = views.salaries(spark, sf)
    return rounded(s.agg(F.min("s_acctbal").alias("min_salary"),
                         F.max("s_acctbal").alias("max_salary")))


@query("row_lookup")
def row_lookup(spark, sf):
    s = vb.point_update(views.salaries(spark, sf), "s_suppkey", "s_acctbal", SALARY_FIXES)
    return rounded(s.where(F.col("s_suppkey").isin(*SALARY_FIXES)))


# --- 2.3 projections, filters ----------------------------------------------------------

@query("select_cols")
def select_cols(spark, sf):
    return views.country_year(spark, sf).select("country", "year", "pop")


@query("drop_cols")
def drop_cols(spark, sf):
    return rounded(views.country_year(spark, sf).drop("continent"))


def _year_rows(spark, sf):
    return views.country_year(spark, sf, year=YEAR)


@query("mutate_col")
def mutate_col(spark, sf):
    cy = _year_rows(spark, sf).select("country", "year", "pop", "gdpPercap")
    return rounded(cy.withColumn("gdp", F.col("pop") * F.col("gdpPercap")))


@query("transmute_col")
def transmute_col(spark, sf):
    cy = _year_rows(spark, sf)
    return rounded(vb.transmute(cy, gdp=F.col("pop") * F.col("gdpPercap")))


@query("top_gdp")
def top_gdp(spark, sf):
    """The five countries with the largest computed gdp."""
    cy = _year_rows(spark, sf).withColumn("gdp", F.col("pop") * F.col("gdpPercap"))
    return rounded(vb.top_n_ties(cy, TOP_GDP, "gdp").select("country", "pop", "gdpPercap", "gdp"))


@query("top_gdp_only")
def top_gdp_only(spark, sf):
    """The five largest computed gdp values, no other column."""
    cy = vb.transmute(_year_rows(spark, sf), gdp=F.col("pop") * F.col("gdpPercap"))
    return rounded(vb.top_n_ties(cy, TOP_GDP, "gdp"))


@query("insert_col")
def insert_col(spark, sf):
    cy = views.country_year(spark, sf)
    return rounded(vb.insert_column(cy, 2, "gdp", F.col("pop") * F.col("gdpPercap")))


@query("point_update")
def point_update(spark, sf):
    s = views.salaries(spark, sf)
    return rounded(vb.point_update(s, "s_suppkey", "s_acctbal", SALARY_FIXES))


@query("if_else_flag")
def if_else_flag(spark, sf):
    cy = _year_rows(spark, sf).select("country", "lifeExp")
    return rounded(cy.withColumn("over", vb.if_else(F.col("lifeExp") > LIFE_EXP_OVER, "Y", "N")))


@query("recode_values")
def recode_values(spark, sf):
    cf = views.customer_features(spark, sf).select("c_custkey", "segment", "region")
    return vb.recode(cf, {"AUTOMOBILE": "AUTO", "AMERICA": "AMERICAS"}, ["segment", "region"])


@query("bin_tenure")
def bin_tenure(spark, sf):
    cf = views.customer_features(spark, sf)
    return cf.select("c_custkey", "tenure", tenure_group("tenure").alias("tenure_group"))


@query("cast_cols")
def cast_cols(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return vb.cast_columns(e, {"event_id": "string", "user_id": "int",
                               "event_type": "int", "props": "int"})


@query("filter_conj")
def filter_conj(spark, sf):
    cy = views.country_year(spark, sf, year=YEAR).select("country", "year", "lifeExp")
    return rounded(cy.where((F.col("year") == YEAR) & (F.col("country") == COUNTRIES[0])))


@query("filter_in")
def filter_in(spark, sf):
    cy = views.country_year(spark, sf, year=YEAR).select("country", "year", "lifeExp")
    return rounded(cy.where((F.col("year") == YEAR) & F.col("country").isin(*COUNTRIES)))


@query("filter_threshold")
def filter_threshold(spark, sf):
    return rounded(views.readings(spark, sf, where=F.col("value") >= HIGH_VALUE))


@query("filter_query_string")
def filter_query_string(spark, sf):
    cf = views.customer_features(spark, sf).select("c_custkey", "n_orders", "tenure")
    return cf.where("n_orders < tenure")


@query("filter_regex")
def filter_regex(spark, sf):
    toks = tt.tokenize(views.pages_text(spark, sf))
    return tt.count_by(toks.where(~F.col("word").rlike("\\d")), ["word"])


@query("complete_cases")
def complete_cases(spark, sf):
    return rounded(vb.complete_cases(views.readings(spark, sf)))


@query("above_quantile")
def above_quantile(spark, sf):
    return rounded(vb.above_quantile(views.rated_items(spark, sf), "points", QUANTILE))


@query("transpose_summary")
def transpose_summary(spark, sf):
    d = pf.describe_numeric(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return rounded(pf.transpose_small(d, "column_name"))


# --- 2.4 joins -----------------------------------------------------------------------------

def _words(spark, sf, strip_numeric=True):
    return tt.tokenize(views.pages_text(spark, sf), strip_numeric=strip_numeric)


def _word_counts(spark, sf):
    """Tokens without numbers and stop words: (document, word, count)."""
    kept = tt.remove_stop_words(_words(spark, sf), lexicons.stop_words(spark))
    return tt.count_by(kept, ["document", "word"], "count")


def _all_words(spark, sf):
    """Every token except the word "1"."""
    return tt.tokenize(views.pages_text(spark, sf)).where(F.col("word") != "1")


@query("anti_join_stop_words")
def anti_join_stop_words(spark, sf):
    kept = tt.remove_stop_words(_words(spark, sf), lexicons.stop_words(spark))
    return tt.count_by(kept, ["document"])


def _country_counts(spark, sf):
    return tt.count_by(views.rated_items(spark, sf), ["country"], "count")


def _selected_countries(spark, sf):
    return vb.top_n_ties(_country_counts(spark, sf), TOP_COUNTRIES, "count").select("country")


@query("semi_join_top_countries")
def semi_join_top_countries(spark, sf):
    ri = views.rated_items(spark, sf)
    return vb.semi_join(ri, _selected_countries(spark, sf), "country").select("country", "points")


def _median_points(df):
    return agg.quantiles(df, "points", [0.5], by=["country"]).withColumnRenamed("q50", "median")


def _top_varieties(spark, sf):
    counts = tt.count_by(views.rated_items(spark, sf), ["variety"], "count")
    return vb.top_n_ties(counts, TOP_VARIETIES, "count").select("variety")


@query("median_top_varieties")
def median_top_varieties(spark, sf):
    """Median points of the most frequent varieties, numbered in their order."""
    kept = vb.semi_join(views.rated_items(spark, sf), _top_varieties(spark, sf), "variety")
    med = agg.quantiles(kept, "points", [0.5], by=["variety"]).withColumnRenamed("q50", "median")
    return rounded(wn.row_number_global(med, ["median", "variety"], name="sort_key"))


@query("box_top_countries")
def box_top_countries(spark, sf):
    """Boxes of the points over the most frequent countries."""
    kept = vb.semi_join(views.rated_items(spark, sf), _selected_countries(spark, sf), "country")
    return rounded(agg.box_stats(kept, "points", ["country"]))


@query("anti_join_top_countries")
def anti_join_top_countries(spark, sf):
    ri = views.rated_items(spark, sf)
    rest = vb.anti_join(ri, _selected_countries(spark, sf), "country")
    return rounded(_median_points(rest))


def _polarity(spark, sf):
    """(axis, word, sentiment, weight) of the two labels: good or bad quality,
    harmless or toxic."""
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("page"), F.col("quality").cast("int").alias("quality"),
        (1 - F.col("toxic").cast("int")).alias("toxic"))
    words = tt.remove_stop_words(_words(spark, sf), lexicons.stop_words(spark)).join(labels, "page")
    words = materialize(words.groupBy("word", "quality", "toxic").agg(F.count(F.lit(1)).alias("n")), "labelled-words")
    return tt.polarity(words, "quality").withColumn("axis", F.lit("quality")).unionByName(
        tt.polarity(words, "toxic").withColumn("axis", F.lit("toxic")))


def _sentiments(spark, sf):
    """(word, sentiment): a word that the labels list on different sides has
    two rows, as in published lists."""
    return materialize(_polarity(spark, sf).select("word", "sentiment").distinct(), "sentiments")


@query("polarity_list")
def polarity_list(spark, sf):
    return rounded(_polarity(spark, sf).select("axis", "word", "sentiment", "weight"))


@query("sentiment_join")
def sentiment_join(spark, sf):
    wc = _word_counts(spark, sf)
    return wc.join(_sentiments(spark, sf), "word")


def _codebook(spark, sf):
    """Four given centres: the 1/8, 3/8, 5/8, 7/8 quantiles of the salaries."""
    s = views.salaries(spark, sf)
    q = agg.quantiles(s, "s_acctbal", [0.125, 0.375, 0.625, 0.875])
    return q.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("code"), F.col(c).alias("center"))
        for i, c in enumerate(["q12_5", "q37_5", "q62_5", "q87_5"])])))


@query("nearest_centroid")
def nearest_centroid(spark, sf):
    s = views.salaries(spark, sf).select("s_suppkey", "s_acctbal")
    return rounded(st.nearest_centroid(s, "s_acctbal", _codebook(spark, sf)).drop("s_acctbal"))


@query("grid_edges")
def grid_edges(spark, sf):
    return gr.grid_edges(views.grid_cells(spark, sf))


# --- 2.5 aggregations ------------------------------------------------------------------------

@query("global_mean")
def global_mean(spark, sf):
    return rounded(views.country_year(spark, sf).agg(F.avg("lifeExp").alias("avgLifeExp")))


@query("group_mean")
def group_mean(spark, sf):
    """filter year -> group by continent -> mean -> flag -> sort (minimum slice)."""
    g = (_year_rows(spark, sf).groupBy("continent")
         .agg(F.avg("lifeExp").alias("avgLifeExp"))
         .withColumn("over", vb.if_else(F.col("avgLifeExp") > LIFE_EXP_OVER, "Y", "N"))
         .orderBy(F.col("avgLifeExp").desc()))
    return rounded(g)


@query("group_mean_all")
def group_mean_all(spark, sf):
    ld = views.labelled_docs(spark, sf)
    return rounded(agg.group_mean_all(ld, ["quality"]))


def _mixed_features(spark, sf):
    cf = views.customer_features(spark, sf)
    return cf.select("segment", "region", "churn", "c_acctbal", "n_orders", "avg_price", "tenure")


CATEGORIES = ("segment", "region", "churn")
MEASURES = ("c_acctbal", "n_orders", "avg_price", "tenure")


@query("group_mean_by_each")
def group_mean_by_each(spark, sf):
    """Means of all numeric columns by each low-cardinality column."""
    return rounded(agg.group_mean_by_each(_mixed_features(spark, sf), CATEGORIES, MEASURES))


@query("box_stats_by_each")
def box_stats_by_each(spark, sf):
    """Boxes of all numeric columns by each low-cardinality column."""
    return rounded(agg.box_stats_by_each(_mixed_features(spark, sf), CATEGORIES, MEASURES))


@query("histogram_all")
def histogram_all(spark, sf):
    """Histograms of all numeric columns."""
    return rounded(agg.histograms(_mixed_features(spark, sf), MEASURES))


@query("group_count")
def group_count(spark, sf):
    return _country_counts(spark, sf).orderBy(F.col("count").desc())


@query("weighted_count")
def weighted_count(spark, sf):
    j = _word_counts(spark, sf).join(_sentiments(spark, sf), "word")
    return j.groupBy("document", "sentiment", "word").agg(F.sum("count").alias("n"))


@query("group_median")
def group_median(spark, sf):
    return rounded(_median_points(views.rated_items(spark, sf)))


@query("population_variance")
def population_variance(spark, sf):
    s = views.salaries(spark, sf)
    return rounded(s.agg(F.min("s_acctbal").alias("min"), F.max("s_acctbal").alias("max"),
                         F.avg("s_acctbal").alias("mean"), F.var_pop("s_acctbal").alias("var"),
                         F.stddev_pop("s_acctbal").alias("std")))


@query("unique_words_by_doc")
def unique_words_by_doc(spark, sf):
    return _all_words(spark, sf).groupBy("document").agg(
        F.countDistinct("word").alias("unique"))


@query("quantile_interp")
def quantile_interp(spark, sf):
    ri = views.rated_items(spark, sf)
    q = agg.quantiles(ri, "points", [QUANTILE]).withColumnRenamed("q85", "points_q85")
    p = agg.quantiles(ri, "price", [QUANTILE]).withColumnRenamed("q85", "price_q85")
    return rounded(q.select("points_q85", p.scalar().alias("price_q85")))


@query("corr_matrix")
def corr_matrix(spark, sf):
    cf = views.customer_features(spark, sf)
    return rounded(pf.corr_matrix(cf, ["c_acctbal", "n_orders", "avg_price", "total_spend",
                                       "tenure"]))


@query("box_stats")
def box_stats(spark, sf):
    return rounded(agg.box_stats(views.readings(spark, sf), "value", ["event_type"]))


@query("box_stats_trimmed")
def box_stats_trimmed(spark, sf):
    return rounded(agg.box_stats(views.readings(spark, sf), "value", ["event_type"],
                                 trimmed=True))


@query("histogram_10")
def histogram_10(spark, sf):
    return rounded(agg.histogram(views.readings(spark, sf), "value", 10))


@query("percent_share")
def percent_share(spark, sf):
    cf = views.customer_features(spark, sf).withColumn("churn", F.col("churn").cast("string"))
    return rounded(agg.percent_share(cf, ["segment", "region", "churn"]))


def _rule_scored(spark, sf):
    """A rule classifier to judge: predict churn when a customer has fewer than
    ten orders.  Deterministic, so its tables have an exact SQL twin."""
    cf = views.customer_features(spark, sf)
    return cf.select("c_custkey", F.col("churn").alias("actual"),
                     (F.col("n_orders") < 10).cast("int").alias("predicted"))


@query("confusion_matrix")
def confusion_matrix(spark, sf):
    return agg.confusion_matrix(_rule_scored(spark, sf), "actual", "predicted")


@query("confusion_stats")
def confusion_stats(spark, sf):
    return rounded(agg.confusion_stats(_rule_scored(spark, sf), "actual", "predicted", 0))


@query("accuracy")
def accuracy(spark, sf):
    s = _rule_scored(spark, sf)
    return rounded(s.agg(agg.accuracy("actual", "predicted").alias("accuracy"),
                         (1 - agg.accuracy("actual", "predicted")).alias("misclassification")))


@query("rmse")
def rmse(spark, sf):
    """Error of the least-squares line of total spend on order count: RMSE
    (to 3 decimals: the values are large) and R^2."""
    cf = views.customer_features(spark, sf)
    fit = cf.agg(F.regr_slope("total_spend", "n_orders").alias("b"),
                 F.regr_intercept("total_spend", "n_orders").alias("a"))
    pred = fit.select("a").scalar() + fit.select("b").scalar() * F.col("n_orders")
    m = cf.select(F.col("total_spend").alias("y"), pred.alias("p")).agg(
        agg.mse("y", "p").alias("mse"), F.var_pop("y").alias("vy"))
    return rounded(m.select(F.round(F.sqrt("mse"), 3).alias("rmse"),
                            (1 - F.col("mse") / F.col("vy")).alias("r2")))


@query("reorder_by_median")
def reorder_by_median(spark, sf):
    med = _median_points(views.rated_items(spark, sf))
    return rounded(wn.row_number_global(med, ["median", "country"], name="sort_key"))


# --- 2.6 windows -------------------------------------------------------------------------------

@query("row_number_by_doc")
def row_number_by_doc(spark, sf):
    p = views.pages_text(spark, sf).select("document", "page")
    return wn.row_number_global(p, ["page"], ["document"], name="linenumber")


@query("distinct_over_group")
def distinct_over_group(spark, sf):
    w = wn.distinct_over_group(_all_words(spark, sf), "document", "word", "unique")
    return tt.count_by(w, ["document", "unique"])


@query("cumsum_series")
def cumsum_series(spark, sf):
    """Running total of daily order value; money is summed as DECIMAL(18, 2)
    so the total is exact whatever the summation order."""
    o = table(spark, sf, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("ds")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
    run = wn.prefix_sum(daily, ["ds"], "value", "cumsum")
    return rounded(run.select("ds", F.col("value").cast("double").alias("value"),
                              F.col("cumsum").cast("double").alias("cumsum")))


@query("cumsum_by_group")
def cumsum_by_group(spark, sf):
    cy = views.country_year(spark, sf).select("country", "year", "pop")
    return wn.cumsum_by_group(cy, "country", ["year"], "pop", "cum_pop")


def _tf_idf(spark, sf):
    counts = tt.count_by(_all_words(spark, sf), ["document", "word"])
    return tt.tf_idf(counts)


@query("tf_idf")
def tf_idf(spark, sf):
    return rounded(_tf_idf(spark, sf))


@query("ecdf")
def ecdf(spark, sf):
    return rounded(wn.ecdf(views.readings(spark, sf), "value"))


@query("ecdf_grid")
def ecdf_grid(spark, sf):
    return rounded(st.ecdf_grid(views.readings(spark, sf), "value", 100))


# --- 2.7 sorts, limits, sampling --------------------------------------------------------------

@query("sort_multi")
def sort_multi(spark, sf):
    r = views.readings(spark, sf).select("event_id", "event_type", "value")
    order = [F.col("event_type").asc_nulls_last(), F.col("value").desc_nulls_last(),
             F.col("event_id").asc()]
    return rounded(wn.row_number_global(r, order, name="pos"))


@query("top_n_ties")
def top_n_ties(spark, sf):
    cy = _year_rows(spark, sf).select("country", "year", "lifeExp")
    return rounded(vb.top_n_ties(cy, TOP_N, "lifeExp"))


@query("top_n_by_group")
def top_n_by_group(spark, sf):
    return rounded(vb.top_n_ties(_tf_idf(spark, sf), TOP_N, "tf_idf", ["document"]))


def _top15percent(ri):
    return vb.above_quantile(ri, "points", QUANTILE)


def _cheapest(ri):
    return vb.limit_by_count(ri, _top15percent(ri), "price",
                             ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def _rated_once(spark, sf):
    """rated_items is read by a quantile, a count, a sort and an intersect:
    join it once and write it to the shared folder."""
    return materialize(views.rated_items(spark, sf), "rated-items")


@query("limit_by_count")
def limit_by_count(spark, sf):
    return rounded(_cheapest(_rated_once(spark, sf)))


@query("top_words")
def top_words(spark, sf):
    return tt.top_words(_all_words(spark, sf), 10, 50)


@query("sample_n")
def sample_n(spark, sf):
    return rounded(vb.sample_n(table(spark, sf, "customer"), 5, ["c_custkey"], SEED))


@query("split_random")
def split_random(spark, sf):
    cf = views.customer_features(spark, sf).select("c_custkey")
    return vb.split_random(cf, ["c_custkey"], 0.8, SEED)


def _stratified(spark, sf):
    return vb.split_stratified(views.customer_features(spark, sf), "churn", ["c_custkey"], 0.7, SEED)


@query("split_stratified")
def split_stratified(spark, sf):
    return _stratified(spark, sf).select("c_custkey", "churn", "is_train")


# --- 2.8 sets ---------------------------------------------------------------------------------

@query("intersect_keys")
def intersect_keys(spark, sf):
    med = _median_points(views.rated_items(spark, sf))
    first = wn.row_number_global(med, [F.col("median").desc(), "country"], name="rank_in_first")
    return vb.intersect_ordered(first, _selected_countries(spark, sf), "country", "rank_in_first")


@query("good_value")
def good_value(spark, sf):
    """Rows that are both in the top 15 % and among the cheapest, each once."""
    ri = _rated_once(spark, sf)
    q = agg.quantiles(ri, "points", [QUANTILE])
    best = ri.where(F.col("points") > q.select(q.columns[0]).scalar())
    return rounded(best.intersect(_cheapest(ri).select(*best.columns)))


@query("complement_rows")
def complement_rows(spark, sf):
    s = _stratified(spark, sf)
    train = s.where("is_train").select("c_custkey")
    return rounded(vb.anti_join(views.customer_features(spark, sf), train, "c_custkey"))


# --- 2.9 scalar functions ----------------------------------------------------------------------

def _bigrams_filtered(spark, sf):
    p = views.pages_text(spark, sf)
    b = tt.separate(tt.ngrams(p, 2), "ngram", ["word1", "word2"])
    return tt.ngram_parts_without_stop_words(b, ["word1", "word2"], lexicons.stop_words(spark))


@query("unite_cols")
def unite_cols(spark, sf):
    u = tt.unite(_bigrams_filtered(spark, sf), "bigram", ["word1", "word2"])
    return tt.count_by(u, ["bigram"])


@query("separate_cols")
def separate_cols(spark, sf):
    b = tt.separate(tt.ngrams(views.pages_text(spark, sf), 2), "ngram", ["word1", "word2"])
    return tt.count_by(b, ["word1", "word2"])


@query("stem_counts")
def stem_counts(spark, sf):
    return tt.stem_counts(_words(spark, sf))


@query("reorder_within")
def reorder_within(spark, sf):
    top = vb.top_n_ties(_tf_idf(spark, sf), TOP_N, "tf_idf", ["document"])
    r = tt.reorder_within(top, "word", "tf_idf", "document", "label")
    return rounded(r.select("document", "word", "tf_idf", "label", "label_key",
                            tx.strip_within_suffix("label").alias("shown")))


@query("clean_text")
def clean_text(spark, sf):
    return tt.clean_text(views.pages_text(spark, sf), lexicons.english_stop_words())


@query("unnest_pages")
def unnest_pages(spark, sf):
    """A document's array of pages (its lines) to one numbered row a page."""
    d = table(spark, sf, "documents").select(
        F.col("doc_id").alias("document"), F.split("text", "\n", -1).alias("pages"))
    return tt.unnest_pages(d).select("document", "page", "text")


# --- 2.10 text ---------------------------------------------------------------------------------

@query("tokenize")
def tokenize(spark, sf):
    return tt.tokenize(views.pages_text(spark, sf))


@query("tokenize_no_numbers")
def tokenize_no_numbers(spark, sf):
    return _words(spark, sf)


@query("word_counts")
def word_counts(spark, sf):
    return _word_counts(spark, sf)


@query("tokens_by_doc")
def tokens_by_doc(spark, sf):
    return tt.count_by(_words(spark, sf), ["document"], "total_lines")


@query("bigram_counts")
def bigram_counts(spark, sf):
    return tt.count_by(tt.ngrams(views.pages_text(spark, sf), 2), ["ngram"]).withColumnRenamed(
        "ngram", "bigram")


@query("trigram_counts")
def trigram_counts(spark, sf):
    t = tt.separate(tt.ngrams(views.pages_text(spark, sf), 3), "ngram",
                    ["word1", "word2", "word3"])
    t = tt.ngram_parts_without_stop_words(t, ["word1", "word2", "word3"],
                                          lexicons.stop_words(spark))
    return tt.count_by(t, ["word1", "word2", "word3"])


@query("bigram_counts_filtered")
def bigram_counts_filtered(spark, sf):
    return tt.count_by(_bigrams_filtered(spark, sf), ["word1", "word2"])


@query("bigram_tf_idf")
def bigram_tf_idf(spark, sf):
    u = tt.unite(_bigrams_filtered(spark, sf), "bigram", ["word1", "word2"])
    scored = tt.tf_idf(tt.count_by(u, ["document", "bigram"]), term="bigram")
    return rounded(vb.top_n_ties(scored, TOP_N, "tf_idf", ["document"]))


@query("bigram_edges")
def bigram_edges(spark, sf):
    b = tt.count_bigrams(views.pages_text(spark, sf), lexicons.stop_words(spark))
    return b.where((F.col("n") > 20) & ~F.col("word1").rlike("\\d") & ~F.col("word2").rlike("\\d"))


@query("sentiment_contribution")
def sentiment_contribution(spark, sf):
    return tt.sentiment_contribution(_word_counts(spark, sf), _sentiments(spark, sf), 10)


@query("doc_term_matrix")
def doc_term_matrix(spark, sf):
    return tt.doc_term_matrix(_word_counts(spark, sf))


# --- 2.11 statistics, graph ------------------------------------------------------------------------

def densities(df: DataFrame) -> DataFrame:
    """Densities over wide ranges are small numbers: 12 decimals."""
    return df.select(*[F.round(c, 12 if c == "density" else DECIMALS).alias(c) if c in ("x", "y", "density")
                       else F.col(c) for c in df.columns])


@query("kde_scott")
def kde_scott(spark, sf):
    return densities(st.kde_1d(views.salaries(spark, sf), "s_acctbal", 200, "scott"))


@query("kde_silverman")
def kde_silverman(spark, sf):
    return densities(st.kde_1d(views.salaries(spark, sf), "s_acctbal", 200, "silverman"))


@query("kde_2d")
def kde_2d(spark, sf):
    s = table(spark, sf, "supplier")
    return densities(st.kde_2d(s, "s_acctbal", "s_nationkey", 100, "scott"))


@query("trend_line")
def trend_line(spark, sf):
    return rounded(st.trend_line(views.rated_items(spark, sf), "points", "price", 20, decimals=2))


@query("smooth_trend")
def smooth_trend(spark, sf):
    """Local regression of price on points."""
    fit = st.smooth(views.rated_items(spark, sf), "points", "price")
    return fit.select("i", F.round("x", DECIMALS).alias("x"), F.round("y_fit", 3).alias("y_fit"))


def _hops(spark, sf):
    cells = views.grid_cells(spark, sf)
    edges = gr.grid_edges(cells)
    return cells, edges, gr.bfs(edges, cells, START)[0]


@query("shortest_hops")
def shortest_hops(spark, sf):
    return _hops(spark, sf)[2].select("r", "c", "hops")


@query("shortest_path")
def shortest_path(spark, sf):
    """From the start to the farthest cell that can be reached."""
    _, _, h = _hops(spark, sf)
    return gr.shortest_path(h, gr.farthest(h))


@query("ascent_path")
def ascent_path(spark, sf):
    """From the farthest cell back to the start by steepest ascent."""
    _, edges, h = _hops(spark, sf)
    return gr.ascent_path(edges, h, gr.farthest(h))


@query("discounted_reach")
def discounted_reach(spark, sf):
    cells, _, h = _hops(spark, sf)
    return rounded(gr.discounted_reach(cells, h, gr.farthest(h)))


def _buyers(spark, sf):
    """Customers and the parts they ordered, as a graph of named nodes."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    pairs = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))
    net = nw.network(pairs)
    return net, net.nodes.where(F.col("name").startswith("c")).agg(F.min("name")).first()[0]


@query("edge_hops")
def edge_hops(spark, sf):
    """Hops of every customer and part from the first customer, and the
    smallest neighbour before."""
    return nw.hops_from(*_buyers(spark, sf))


@query("edge_path")
def edge_path(spark, sf):
    """From the first customer to the farthest node (then the last by name)."""
    net, start = _buyers(spark, sf)
    goal = nw.hops_from(net, start).agg(F.max(F.struct("hops", "node"))).first()[0].node
    return nw.path_between(net, start, goal)


@query("edge_reach")
def edge_reach(spark, sf):
    return rounded(nw.discounted_from(*_buyers(spark, sf)))
