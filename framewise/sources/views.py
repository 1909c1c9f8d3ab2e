"""Stand-in views: the shapes the analyses expect, built from the given tables.

Each view pre-aggregates the large side before it joins, so the join input
shrinks to one row per key; the dimension tables (nation, region) are fixed
25 / 5 row tables and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.functions.binning import nan_to_null
from framewise.sources.tables import raw_table, spread, table

GRID_WIDTH = 50          # grid_cells: column = key mod 50, row = key div 50
WALL_SIZE = 35           # grid_cells: wall when p_size > 35
CHURN_BEFORE = "2001-01-01"
# Money columns carry two decimals: sums run in DECIMAL, which is exact and
# independent of partitioning, then become DOUBLE once.
MONEY = "decimal(18,2)"


def _exact_sum(c):
    return F.sum(c).cast("double")


def _geo(spark, sf_dir) -> DataFrame:
    """nation -> (nation key, country, continent); 25 rows by definition."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return F.broadcast(
        n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
         .select("n_nationkey", F.col("n_name").alias("country"),
                 F.col("r_name").alias("continent")))


def country_year(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """(country, continent, year, lifeExp, pop, gdpPercap), one row per nation-year.

    With ``year`` the orders are cut to that calendar year by a date range on
    the raw column, which the parquet scan can use to skip row groups (a
    filter on ``year(o_orderdate)`` could not be pushed to the file)."""
    o = table(spark, sf_dir, "orders")
    if year is not None:
        o = o.where((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) &
                    (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    per_cust = (o.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
                 .agg(F.count(F.lit(1)).alias("k"),
                      F.sum(F.col("o_totalprice").cast(MONEY)).alias("price_sum")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
         .join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))
    return (j.groupBy("country", "continent", "year")
             .agg((_exact_sum(F.col("c_acctbal").cast(MONEY) * F.col("k")) / F.sum("k") / 100)
                  .alias("lifeExp"),
                  F.count(F.lit(1)).alias("pop"),
                  (_exact_sum(F.col("price_sum")) / F.sum("k")).alias("gdpPercap")))


def rated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the rated-item columns of its part and supplier."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("description"),
        F.col("p_brand").alias("variety"), F.col("p_size").alias("points"),
        F.col("p_retailprice").alias("price"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = _geo(spark, sf_dir).select("n_nationkey", "country")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .join(s, li.l_suppkey == s.s_suppkey)
              .join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      "country", "description", "variety", "points", "price"))


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ordering customer: spend, tenure in months, churn flag."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast(MONEY)
    per = (o.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 (_exact_sum(price) / F.count(F.lit(1))).alias("avg_price"),
                 _exact_sum(price).alias("total_spend"),
                 F.min("o_orderdate").alias("first_o"),
                 F.max("o_orderdate").alias("last_o")))
    c = table(spark, sf_dir, "customer")
    geo = _geo(spark, sf_dir)
    months = lambda d: F.year(d) * 12 + F.month(d)
    return (per.join(c, per.o_custkey == c.c_custkey)
               .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
               .select("c_custkey",
                       F.col("c_mktsegment").alias("segment"),
                       F.col("continent").alias("region"),
                       "c_acctbal", "n_orders", "avg_price", "total_spend",
                       (months("last_o") - months("first_o")).cast("int").alias("tenure"),
                       F.when(F.col("last_o") < F.lit(CHURN_BEFORE).cast("timestamp_ntz"), 1)
                        .otherwise(0).alias("churn")))


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select("doc_id", "lang", "source", "n_chars",
                                        "quality", "toxic")


def readings(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """events with NULL injected where value = 0.01 (exercise missing rules).

    ``where`` is a condition on the raw event columns, applied before the
    NULL injection so that it reaches the parquet scan."""
    e = raw_table(spark, sf_dir, "events")
    if where is not None:
        e = e.where(where)
    return nan_to_null(e).select("event_id", "ts", "user_id", "event_type",
                    F.expr("nullif(value, 0.01)").alias("value"))


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")


def pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as (document, page, text): document = source."""
    return spread(table(spark, sf_dir, "documents").select(
        F.col("source").alias("document"), F.col("doc_id").alias("page"), "text"))


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2-D grid from part: r = key div 50, c = key mod 50, wall = size > 35."""
    p = table(spark, sf_dir, "part")
    return p.select(F.expr(f"p_partkey div {GRID_WIDTH}").alias("r"),
                    F.expr(f"p_partkey % {GRID_WIDTH}").alias("c"),
                    (F.col("p_size") > WALL_SIZE).alias("wall"))
