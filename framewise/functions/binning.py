"""Value binning and missing-value expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tenure groups, right-closed, first bin closed at 0; a
# negative tenure belongs to no group (NULL).
TENURE_GROUPS = (
    (0, 12, "0-12 Month"),
    (12, 24, "12-24 Month"),
    (24, 48, "24-48 Month"),
    (48, 60, "48-60 Month"),
    (60, None, "> 60 Month"),
)


def tenure_group(c) -> Column:
    v = F.col(c) if isinstance(c, str) else c
    expr = None
    for lo, hi, label in TENURE_GROUPS:
        cond = (v >= lo) if lo == 0 else (v > lo)
        if hi is not None:
            cond = cond & (v <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr  # no otherwise(): values outside every bin stay NULL


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, once, at load."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (schema metadata only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
