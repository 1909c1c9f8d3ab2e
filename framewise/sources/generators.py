"""Spines derived from data: calendars, integer ranges, evenly spaced grids.

The span comes from an aggregate of the input (one row) and the spine is
generated from it with ``sequence`` + ``explode``; spines are bounded by
their span (days, years, grid size), not by the number of input rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, ts: str, periods: int | None = None) -> DataFrame:
    """Daily calendar from the first date of ``ts``: ``periods`` days, or up to
    the last date when ``periods`` is None."""
    first = F.to_date(F.min(ts))
    last = F.date_add(first, periods - 1) if periods else F.to_date(F.max(ts))
    span = df.agg(first.alias("a"), last.alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("ds"))


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    """Events per day on a complete daily spine (days without rows give 0)."""
    spine = date_spine(df, ts)
    counts = df.groupBy(F.to_date(ts).alias("ds")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "ds", "left").select(
        "ds", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def int_range_counts(df: DataFrame, key) -> DataFrame:
    """Every integer from min(key) to max(key) with its row count (0 if none)."""
    k = F.col(key) if isinstance(key, str) else key
    base = df.select(k.cast("int").alias("k"))
    span = base.agg(F.min("k").alias("a"), F.max("k").alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b")).alias("k"))
    counts = base.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "k", "left").select(
        "k", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def grid_points(df: DataFrame, value: str, num: int) -> DataFrame:
    """``num`` evenly spaced points from min to max of a column, ends included."""
    span = df.agg(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"))
    return span.select(F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(num - 1)),
        lambda i: F.col("a") + i * ((F.col("b") - F.col("a")) / (num - 1)))).alias("i", "x"))
