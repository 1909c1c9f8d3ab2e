"""Readers for the given tables and explicit schemas for text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from framewise.functions.binning import nan_to_null

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, with NaN turned into NULL in floating columns; parquet
    carries its own schema."""
    return nan_to_null(raw_table(spark, sf_dir, name))


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table as it is stored: conditions on its columns reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan that is planned as fewer tasks than the session has cores is
    dealt out to all of them (its rows move once); others stay as they are.
    For columns whose processing costs far more than moving them, as texts."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    planned = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if planned < cores else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temporary view for ``spark.sql``."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


# Explicit schemas for row-text formats (CSV); inference is for profiling only.
SCHEMAS: dict[str, T.StructType] = {
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    "readings": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]),
}
