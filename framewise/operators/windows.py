"""Window operators: numbering, running totals, shares, ECDF.

Unpartitioned windows (``Window.orderBy(...)`` with no partition) run in a
single task.  The operators here avoid that on raw rows:

* ``row_number_global`` numbers rows of a total order exactly with a range
  sort (many tasks) plus per-partition offsets from a table with one row per
  partition;
* ``prefix_sum`` is a running total with the same technique: a local running
  sum inside each range-sorted partition plus the totals of the partitions
  before it;
* ``ecdf`` is a prefix sum of value counts (equal values merged first)
  divided by n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.keys import join_on
from framewise.session import materialize

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def row_number_global(df: DataFrame, order: Sequence, partition_by: Sequence[str] = (),
                      name: str = "row_number", size: str | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by P order by O)`` for any skew.

    The frame is range-sorted on (P, O), so one hot group is spread over many
    sorted partitions.  Inside a partition the rows of a group are contiguous;
    a small table of (partition, group) counts gives each slice its offset.
    ``size`` names an optional column with the number of rows of the group.
    ``order`` must be a total order (end it with a unique key).  The sorted
    frame is written to the shared folder so both passes, and any recomputation after an
    executor loss, see the same partitions.
    """
    part = list(partition_by)
    keys = _cols(part) + _cols(order)
    sorted_df = (df.orderBy(*keys)
                   .withColumn("_mid", F.monotonically_increasing_id())
                   .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
                   .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)))
    sorted_df = materialize(sorted_df, "numbered")
    slices = sorted_df.groupBy("_pid", *part).agg(F.count(F.lit(1)).alias("_n"),
                                                   F.min("_pos").alias("_start"))
    # one row per (partition, group): tiny next to the data
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1) if part else Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    extra = []
    if size:  # rows in the whole group, from the same small table
        offsets = offsets.withColumn(size, F.sum("_n").over(Window.partitionBy(*part)))
        extra = [size]
    offs = offsets.select("_pid", *part, "_off", "_start", *extra)
    # without groups the offsets table has one row per partition: broadcast it
    joined = join_on(sorted_df, offs if part else F.broadcast(offs), ["_pid", *part])
    return (joined.withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_start") + 1)
                              .cast("bigint"))
                  .drop("_mid", "_pid", "_pos", "_off", "_start"))


def cumsum_by_group(df: DataFrame, group: str, order: Sequence[str], value: str,
                    name: str) -> DataFrame:
    """Running total inside each group in ``order`` (a unique key per group);
    a hot group is spread over many sorted partitions."""
    return prefix_sum(df, order, value, name, [group])


def distinct_over_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Distinct count of ``value`` repeated on each row of its group.

    ``count(distinct) over`` is not supported; aggregate then join back.
    """
    d = df.groupBy(group).agg(F.countDistinct(value).alias(name))
    return join_on(df, d, [group])


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """(value, n_le, ecdf): share of non-NULL observations <= each distinct value.

    Equal values are merged into counts first; the running count over
    distinct values is a distributed ``prefix_sum``, whose offsets table also
    holds the total, so the source is read once.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("_k"))
    numbered = prefix_sum(counts, [value], "_k", "n_le", total="_total")
    return numbered.select(value, F.col("n_le").cast("bigint").alias("n_le"),
                           (F.col("n_le") / F.col("_total")).alias("ecdf"))


def prefix_sum(df: DataFrame, order: Sequence[str], weight: str, name: str,
               by: Sequence[str] = (), total: str | None = None) -> DataFrame:
    """Inclusive prefix sum of ``weight`` in ``order`` within each group of
    ``by``, distributed; ``total`` names a column for the group's sum.

    Range-sort on (group, order), then per sorted partition a local running
    sum (a window partitioned by the partition id, so every task works on its
    own slice) plus the total of the group's earlier partitions from a table
    with one row per (partition, group).
    """
    part = list(by)
    s = materialize(df.orderBy(*part, *order).withColumn(
        "_pid", F.shiftright(F.monotonically_increasing_id(), _POS_BITS)), "prefix")
    local = Window.partitionBy("_pid", *part).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    slices = s.groupBy("_pid", *part).agg(F.sum(weight).alias("_t"))
    groups = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    before = groups.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    extra = [total] if total else []
    if total:
        offsets = offsets.withColumn(total, F.sum("_t").over(groups))
    offsets = offsets.select("_pid", *part, "_off", *extra)
    # without groups the offsets table has one row per partition: broadcast it
    summed = s.withColumn("_local", F.sum(weight).over(local))
    return (join_on(summed, offsets if part else F.broadcast(offsets), ["_pid", *part])
            .withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_off", "_local"))
