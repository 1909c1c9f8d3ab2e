"""Joins on group keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where NULL equals NULL; the keys come from the left."""
    renamed = {k: f"_r{i}_{k}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(renamed)
    cond = None
    for k, r in renamed.items():
        same = F.col(k).eqNullSafe(F.col(r))
        cond = same if cond is None else cond & same
    return left.join(other, cond, how).drop(*renamed.values())
