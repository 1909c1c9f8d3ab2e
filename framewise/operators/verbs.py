"""Table verbs: projection, filters, recodes, sorts, top-n, sampling, splits, sets.

Every function maps DataFrame -> DataFrame and is meant for ``df.transform``.
Ordering is never implicit: every sort and window names a unique key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.keys import join_on


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- projections -----------------------------------------------------------

def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    """Insert a computed column at an ordinal position (0-based)."""
    cols = [F.col(c) for c in df.columns]
    return df.select(*cols[:position], value.alias(name), *cols[position:])


def transmute(df: DataFrame, **exprs: Column) -> DataFrame:
    """Keep only the computed columns."""
    return df.select(*[e.alias(k) for k, e in exprs.items()])


def point_update(df: DataFrame, key: str, column: str, updates: Mapping) -> DataFrame:
    """Set ``column`` to a new value on rows whose ``key`` matches (by label)."""
    expr = None
    for k, v in updates.items():
        cond = F.col(key) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    typ = dict(df.dtypes)[column]
    return df.withColumn(column, expr.otherwise(F.col(column)).cast(typ))


def if_else(cond: Column, yes, no) -> Column:
    return F.when(cond, yes).otherwise(no)


def recode(df: DataFrame, mapping: Mapping, columns: Sequence[str]) -> DataFrame:
    """Replace listed values in several columns (value -> value)."""
    return df.replace(dict(mapping), subset=list(columns))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; ``try_cast`` (bad input -> NULL) unless ``strict``."""
    out = []
    for c in df.columns:
        if c in types:
            out.append((F.col(c).cast(types[c]) if strict
                        else F.col(c).try_cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# --- filters ---------------------------------------------------------------

def filter_not_in(df: DataFrame, column: str, values: Sequence, keep_null: bool = True) -> DataFrame:
    """NOT IN a literal set; NULL rows are kept (``!(x %in% s)`` is TRUE for NA)."""
    cond = ~F.col(column).isin(list(values))
    if keep_null:
        cond = F.col(column).isNull() | cond
    return df.where(cond)


def complete_cases(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def above_quantile(df: DataFrame, column: str, prob: float) -> DataFrame:
    """Rows whose value is above the table's own interpolated quantile.

    The quantile (exact, skew-safe) is an uncorrelated scalar subquery; the
    filter then runs in the scan stage of the main query.
    """
    from framewise.operators.aggregates import quantiles

    q = quantiles(df, column, [prob])
    return df.where(F.col(column) > q.select(q.columns[0]).scalar())


# --- sorts, top-n, limits ---------------------------------------------------

def sort_nulls_last(df: DataFrame, *keys) -> DataFrame:
    """Sort with NULLs last in both directions. Keys: name, or (name, 'desc')."""
    order = []
    for k in keys:
        name, direction = (k, "asc") if isinstance(k, str) else k
        c = F.col(name)
        order.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
    return df.orderBy(*order)


def top_n_ties(df: DataFrame, n: int, by: str, partition_by: Sequence[str] = (),
               rank_col: str | None = None) -> DataFrame:
    """Rows ranked <= n by ``by`` descending, ties kept (min rank); NULLs dropped.

    The n largest distinct values of a group with their counts give the rank
    of each of them (at most n rows a group reach that window); the rows are
    then joined with the values ranked <= n, so any number of ties stays
    spread over the tasks.
    """
    part = list(partition_by)
    base = df.where(F.col(by).isNotNull())
    counts = base.groupBy(*part, by).agg(F.count(F.lit(1)).alias("_k"))
    groups = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    if part:
        first = counts.withColumn("_i", F.row_number().over(groups.orderBy(F.col(by).desc())))
        first = first.where(F.col("_i") <= n).drop("_i")
    else:
        first = counts.orderBy(F.col(by).desc()).limit(n)
    before = groups.orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    r = rank_col or "_rank"
    ranks = (first.withColumn(r, (F.coalesce(F.sum("_k").over(before), F.lit(0)) + 1).cast("int"))
             .where(F.col(r) <= n).select(*part, by, r))
    out = join_on(base, ranks if part else F.broadcast(ranks), [*part, by])  # global: at most n values
    return out if rank_col else out.drop(r)


def limit_by_count(df: DataFrame, counted: DataFrame, by: str, keys: Sequence[str]) -> DataFrame:
    """First ``count(counted)`` rows of ``df`` by (``by`` ascending with NULL
    last, ``keys``); ``keys`` is unique.

    The running count over the distinct values of ``by`` gives the value at
    which the limit falls; rows below it stay, and only the rows tied at it
    are numbered."""
    from framewise.operators.windows import prefix_sum, row_number_global

    k = counted.count()
    values = df.groupBy(by).agg(F.count(F.lit(1)).alias("_k"))
    cum = prefix_sum(values.withColumn("_null", F.col(by).isNull()), ["_null", by], "_k", "_cum")
    cut = (cum.where((F.col("_cum") >= k) & (F.col("_cum") - F.col("_k") < k))
           .select(by, (F.col("_cum") - F.col("_k")).alias("_before")).first())  # one value
    if cut is None:  # the limit is beyond the table, or 0
        return df if k else df.where(F.lit(False))
    at = F.lit(cut[by]).cast(df.schema[by].dataType)
    below = F.col(by).isNotNull() if cut[by] is None else F.col(by) < at
    ties = row_number_global(df.where(F.col(by).eqNullSafe(at)), list(keys), name="_rn")
    return df.where(below).unionByName(ties.where(F.col("_rn") <= k - cut["_before"]).drop("_rn"))


def draw(key: Sequence[str], seed: int) -> Column:
    """A repeatable draw from a key of any type and size: the hex digits of
    the MD5 of its text and the seed, uniform in string order."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def draw_below(share: float) -> str:
    """The first draw that is not below ``share``."""
    return f"{round(share * 2 ** 32):08x}" if share < 1 else "g"


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows drawn without replacement, repeatable: smallest draws of the key."""
    return df.withColumn("_h", draw(key, seed)).orderBy("_h", *key).limit(n).drop("_h")


def split_random(df: DataFrame, key: Sequence[str], frac: float = 0.8, seed: int = 123) -> DataFrame:
    """``df`` with ``is_train``, true for a repeatable share ``frac`` of the keys."""
    return df.withColumn("is_train", draw(key, seed) < draw_below(frac))


def split_stratified(df: DataFrame, label: str, key: Sequence[str], frac: float = 0.7,
                     seed: int = 1234) -> DataFrame:
    """Adds ``is_train``: per label (NULL is one), the first ``frac`` share in
    draw order, i.e. ``percent_rank() over (partition by label order by draw,
    key) < frac``.

    A label is a hot group by nature (two labels hold all rows), so the rank
    comes from ``row_number_global``: a range sort spreads each stratum over
    many tasks, and the stratum size comes from its small offsets table.
    """
    from framewise.operators.windows import row_number_global

    u = df.withColumn("_h", draw(key, seed))
    n = row_number_global(u, ["_h", *key], [label], name="_rn", size="_n")
    pr = F.try_divide(F.col("_rn") - 1, F.col("_n") - 1)
    return n.withColumn("is_train", F.coalesce(pr, F.lit(0.0)) < frac).drop("_h", "_rn", "_n")


# --- sets and key filters ----------------------------------------------------

def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_anti")


def intersect_ordered(first: DataFrame, second: DataFrame, key: str, order_col: str) -> DataFrame:
    """Distinct keys present in both, keeping the first frame's order column."""
    common = first.select(key).intersect(second.select(key))
    order = first.groupBy(key).agg(F.min(order_col).alias(order_col))
    return common.join(order, key)
