"""Profiling: shape, types, numeric and categorical summaries, missing counts,
cardinality, value counts, correlation.

Each profile is one scan: every per-column statistic is an expression of a
single ``agg``, and the wide one-row result is turned into rows with
``stack`` (unpivot) on the executor side; the driver only reads the schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions.binning import numeric_columns, string_columns


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null): schema plus a count scan."""
    aggs = [F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    parts = []
    for i, f in enumerate(df.schema.fields):
        parts += [F.lit(i + 1), F.lit(f.name), F.lit(f.dataType.simpleString()),
                  F.col(f"_nn{i}")]
    stacked = F.inline(F.array(*[
        F.struct(parts[4 * i].alias("position"), parts[4 * i + 1].alias("column_name"),
                 parts[4 * i + 2].alias("data_type"), parts[4 * i + 3].alias("non_null"))
        for i in range(len(df.columns))]))
    return wide.select(stacked)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles, max for numeric columns; one
    output row per column, NULL figures for a column without values.

    The moments of all columns are one wide aggregate; for the quartiles the
    columns are unpivoted to (column_name, value) rows, equal values merged
    and range-sorted (``quantiles``), so no task holds a column.
    """
    from framewise.operators.aggregates import quantiles

    cols = list(columns) if columns else numeric_columns(df)
    stats = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}")
                    for i, c in enumerate(cols) for n, f in stats])
    moments = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}{i}").alias(n) for n, _ in stats])
        for i, c in enumerate(cols)])))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    q = quantiles(long, "value", [0.25, 0.5, 0.75], ["column_name"])
    return moments.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top, freq for string columns in one pass over
    (column, value) counts.  Tie rule for top: highest count, then smallest value."""
    cols = list(columns) if columns else string_columns(df)
    long = df.select(*cols).unpivot([], cols, "column_name", "value").where(
        F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("column_name").agg(
        F.sum("k").cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("k")).alias("nk"), F.col("value").alias("v")))["v"].alias("top"),
        F.max("k").alias("freq"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for every column, one scan.  NaN counts as missing."""
    aggs = [F.sum(F.when(_missing(df, c), 1).otherwise(0)).cast("bigint").alias(f"_m{i}")
            for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"_m{i}").alias("n_missing"))
        for i, f in enumerate(df.schema.fields)])))


def _missing(df: DataFrame, column: str):
    c = F.col(column)
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def any_missing(df: DataFrame, column: str) -> DataFrame:
    """One row: whether the column has a NULL (or NaN, if it is floating)."""
    return df.agg(F.coalesce(F.max(_missing(df, column)), F.lit(False)).alias("any_missing"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """(column_name, n_distinct) per column; ``approx`` uses HyperLogLog++."""
    cols = list(columns) if columns else df.columns
    f = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[f(F.col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_d{i}").alias("n_distinct"))
        for i, c in enumerate(cols)])))


def low_cardinality(df: DataFrame, below: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with fewer than ``below`` distinct non-NULL values.

    At scale the screen runs on the HyperLogLog sketch first; only columns
    that could qualify (estimate under 2·below) get an exact distinct count.
    """
    cols = list(columns) if columns else df.columns
    screen = distinct_counts(df, cols, approx=True).where(F.col("n_distinct") < 2 * below)
    candidates = [r["column_name"] for r in screen.collect()]  # <= one row per column
    if not candidates:
        return distinct_counts(df, cols[:1]).where(F.lit(False))
    return distinct_counts(df, candidates).where(F.col("n_distinct") < below)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(column)))


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, long form, one scan
    (pairwise-complete: each ``corr`` skips rows where either side is NULL).
    Each unordered pair is computed once and given out in both orders."""
    cols = list(columns) if columns else numeric_columns(df)
    half = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                    for i, (a, b) in enumerate(half)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"), F.col(f"_c{i}").alias("corr"))
        for i, (a, b) in enumerate(half) for x, y in dict.fromkeys([(a, b), (b, a)])])))


def transpose_small(df: DataFrame, key: str) -> DataFrame:
    """Rows <-> columns for a small summary frame: unpivot then pivot on ``key``.

    Both steps are distributed; the pivot needs the key values, which a
    summary (bounded rows) supplies.
    """
    value_cols = [c for c in df.columns if c != key]
    long = df.select(F.col(key).cast("string").alias(key),
                     *[F.col(c).cast("double").alias(c) for c in value_cols]).unpivot(
        [key], value_cols, "field", "value")
    return long.groupBy("field").pivot(key).agg(F.first("value"))


def tail_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last n rows in ``order``: top-n descending (distributed top-k), re-sorted."""
    desc = [F.col(c).desc() for c in order]
    return df.orderBy(*desc).limit(n).orderBy(*order)


__all__ = ["shape", "column_types", "describe_numeric", "describe_categorical",
           "null_counts", "any_missing", "distinct_counts", "low_cardinality",
           "value_counts", "corr_matrix", "transpose_small", "tail_rows"]
