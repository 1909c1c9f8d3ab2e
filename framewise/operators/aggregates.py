"""Aggregations: group statistics, quantiles, box and histogram data,
confusion tables and error measures.

Exact quantiles (``quantiles``, ``box_stats``) merge equal values first and
number the distinct values of each group with a range sort, so no task holds
a whole group, however skewed; the path is the same at every size.  Group
keys may be NULL: joins back on them are null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.functions.binning import numeric_columns
from framewise.operators.keys import join_on
from framewise.session import materialize


def group_mean_all(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of every numeric non-key column by group (text columns skipped)."""
    nums = [c for c in numeric_columns(df) if c not in by]
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in nums])


def _qname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"q{s}"


def ranked_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, _k, _cum, _n): each distinct value of a group with its
    count, the running count up to and including it, and the group size.

    Equal values are merged first.  The merged rows are range-sorted on
    (group, value), so a group holding a third of the data is spread over
    many sorted partitions; each partition keeps a local running count and a
    small table of (partition, group) totals gives every slice its offset.
    The sorted rows are written to the shared folder, so both passes (and any recomputation
    after an executor loss) see the same partitions.
    """
    from pyspark.sql import Window

    counts = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
                .agg(F.count(F.lit(1)).alias("_k")))
    s = materialize(counts.orderBy(*by, value).withColumn("_pid", F.spark_partition_id()),
                    "ranked")
    local = Window.partitionBy("_pid", *by).orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0)
    slices = s.groupBy("_pid", *by).agg(F.sum("_k").alias("_t"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = slices.select("_pid", *by,
                         F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
                         F.sum("_t").over(Window.partitionBy(*by)).alias("_n"))
    return (join_on(s.withColumn("_cum", F.sum("_k").over(local)), offs, ["_pid", *by])
             .select(*by, value, "_k", (F.col("_cum") + F.col("_off")).alias("_cum"), "_n"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` per group, one column per
    prob named ``q<prob*100>``; NULL values are ignored, a group without any
    other value has no row.  Only the two rows around each target rank of a
    group reach the final aggregate.
    """
    names = [_qname(p) for p in probs]
    r = ranked_values(df, value, by)
    start = F.col("_cum") - F.col("_k")  # the row holds 0-based ranks [start, _cum)
    holds, parts = [], []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * float(p)
        for tag, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (start <= rank) & (rank < F.col("_cum"))
            holds.append(hit)
            parts.append(F.max(F.when(hit, F.col(value))).alias(f"_{tag}{i}"))
        parts.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
    keep = holds[0]
    for h in holds[1:]:
        keep = keep | h
    g = r.where(keep).groupBy(*by).agg(*parts)  # at most 2 rows per prob per group
    return g.select(*by, *[
        (F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n)
        for i, n in enumerate(names)])


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), whisker: float = 1.5,
              trimmed: bool = False) -> DataFrame:
    """Box-plot data per group: n, q1, median, q3, whiskers (furthest point
    within ``whisker``·IQR of the box), outlier count.

    With ``trimmed`` the outliers are left out of n (they are not drawn).
    Whiskers and outlier counts come from the (group, value, count) rows
    joined to one row of quartiles per group.
    """
    base = df.where(F.col(value).isNotNull())
    counts = base.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_f"))
    q = quantiles(df, value, [0.25, 0.5, 0.75], by).select(
        *by, F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"))
    lo = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    if by:
        j = join_on(counts, q, list(by))
    else:  # one box: the quartiles are scalar subqueries, not a join
        j = counts.select("*", *[q.select(c).scalar().alias(c)
                                 for c in ("q1", "median", "q3")])
    inside = (F.col(value) >= lo) & (F.col(value) <= hi)
    n_expr = F.sum(F.when(inside, F.col("_f")).otherwise(0)) if trimmed else F.sum("_f")
    out = j.groupBy(*by, "q1", "median", "q3").agg(
        n_expr.cast("bigint").alias("n"),
        F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
        F.sum(F.when(~inside, F.col("_f")).otherwise(0)).cast("bigint").alias("n_outliers"))
    if trimmed:
        out = out.drop("n_outliers")
    return out


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column_name, value) with the columns as doubles."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "column_name", "value")


def box_stats_by_each(df: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Box data of every numeric column by every categorical column:
    (by_column, level, column_name, box...).  The levels are unpivoted too, so
    all boxes come from one pass over the rows."""
    levels = F.explode(F.array(*[F.struct(F.lit(c).alias("by_column"),
                                          F.col(c).cast("string").alias("level")) for c in columns]))
    long = _long(df.select(levels.alias("_g"), *values).select("_g.by_column", "_g.level", *values),
                 values, ["by_column", "level"])
    return box_stats(long, "value", ["by_column", "level", "column_name"])


def group_mean_by_each(df: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Means of the numeric columns by the levels of every categorical column."""
    levels = F.explode(F.array(*[F.struct(F.lit(c).alias("by_column"),
                                          F.col(c).cast("string").alias("level")) for c in columns]))
    return (df.select(levels.alias("_g"), *values).groupBy("_g.by_column", "_g.level")
              .agg(*[F.avg(c).alias(c) for c in values]))


def histograms(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """(column_name, bin, bin_lo, bin_hi, n): equal-width histogram of every
    numeric column over its own [min, max].

    The last bin is closed, empty bins are kept.  A constant column gets the
    range half a unit to both sides; a column without values has NULL edges
    and counts of 0.  Edges come from one aggregate row, the counts from one
    pass over the unpivoted rows; the spine has ``bins`` rows a column, so
    broadcasting the counts onto it is bounded.
    """
    cols = list(columns) if columns else numeric_columns(df)
    ends = df.agg(*[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols)
                    for k, f in (("lo", F.min), ("hi", F.max))]).first()  # one row
    edges = []
    for i, c in enumerate(cols):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        edges.append((c, lo, hi))
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame(edges, "column_name string, lo double, hi double"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (_long(df, cols).where(F.col("value").isNotNull()).join(table, "column_name")
              .groupBy("column_name", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    spine = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(F.broadcast(counts), ["column_name", "bin"], "left").select(
        "column_name", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """``histograms`` of one column: (bin, bin_lo, bin_hi, n)."""
    return histograms(df, [value], bins).drop("column_name")


def percent_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, level, n, pct) for several categorical columns in one pass:
    unpivot, count, divide by the column total."""
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot(
        [], list(columns), "variable", "level")
    counts = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("_total"))  # one row a column
    return counts.join(F.broadcast(totals), "variable").select(
        "variable", "level", "n", (100.0 * F.col("n") / F.col("_total")).alias("pct"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Two-way table over the labels present on either side, zero cells kept;
    a NULL label is a label of its own."""
    a = F.col(actual)
    p = F.col(predicted).cast(df.schema[actual].dataType)
    counts = df.groupBy(a.alias("actual"), p.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    label = lambda c: F.struct(F.col(c).alias("v"))  # noqa: E731  keeps NULL in the set
    present = counts.agg(F.array_distinct(F.flatten(F.collect_list(
        F.array(label("actual"), label("predicted"))))).alias("l"))
    cells = (present.select(F.explode("l").alias("x"), "l")
             .select(F.col("x.v").alias("actual"), F.explode("l").alias("y"))
             .select("actual", F.col("y.v").alias("predicted")))
    return join_on(cells, counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_stats(df: DataFrame, actual: str, predicted: str, positive=0) -> DataFrame:
    """Accuracy and kappa over all labels; sensitivity, specificity, PPV, NPV,
    prevalence, balanced accuracy of ``positive`` against the rest.

    One pass counts the (actual, predicted) cells; all figures are sums over
    these few rows.  A NULL label equals only NULL."""
    cells = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    pos = F.lit(positive)
    a, p, n = F.col("a").eqNullSafe(pos), F.col("p").eqNullSafe(pos), F.col("n")
    # chance agreement: sum over labels of (row total) * (column total)
    rows = cells.groupBy(F.col("a").alias("label")).agg(F.sum("n").alias("nr"))
    columns = cells.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("nc"))
    chance = join_on(rows, columns, ["label"]).agg(
        F.coalesce(F.sum(F.col("nr").cast("double") * F.col("nc")), F.lit(0.0)))
    s = cells.agg(
        F.sum(F.when(a & p, n).otherwise(0)).alias("tp"),
        F.sum(F.when(~a & p, n).otherwise(0)).alias("fp"),
        F.sum(F.when(a & ~p, n).otherwise(0)).alias("fn"),
        F.sum(F.when(~a & ~p, n).otherwise(0)).alias("tn"),
        F.sum(F.when(F.col("a").eqNullSafe(F.col("p")), n).otherwise(0)).cast("double").alias("same"),
        F.sum(n).cast("double").alias("n")).withColumn("chance", chance.scalar())
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    d = F.try_divide  # an empty margin gives NULL, not an error
    acc = d(F.col("same"), F.col("n"))
    pe = d(F.col("chance"), F.col("n") * F.col("n"))
    sens = d(tp, tp + fn)
    spec = d(tn, tn + fp)
    return s.select(
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        F.col("fn").cast("bigint").alias("fn"), F.col("tn").cast("bigint").alias("tn"),
        acc.alias("accuracy"), d(acc - pe, 1 - pe).alias("kappa"),
        sens.alias("sensitivity"), spec.alias("specificity"),
        d(tp, tp + fp).alias("ppv"), d(tn, tn + fn).alias("npv"),
        d(tp + fn, F.col("n")).alias("prevalence"), ((sens + spec) / 2).alias("balanced_accuracy"))


def accuracy(actual: str, predicted: str) -> Column:
    return F.avg((F.col(actual) == F.col(predicted)).cast("double"))


def mse(actual: str, predicted: str) -> Column:
    return F.avg(F.pow(F.col(actual) - F.col(predicted), 2))
