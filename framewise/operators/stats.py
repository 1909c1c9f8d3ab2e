"""Distribution statistics: kernel density, ECDF on a grid, trend line, local
regression, nearest-centroid assignment.

Evaluations on a grid (densities, the smoother) first merge the rows into
cells or buckets by one grouped sum, whose partial sums are made map-side;
only cells meet grid points.  Grid sizes are parameters (bounded); the
scalars that place the grid (min, max, covariance) come from one aggregate
row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.windows import prefix_sum
from framewise.session import materialize


def linspace(a: Column, b: Column, num: int, i: Column) -> Column:
    """i-th of ``num`` evenly spaced points from a to b, ends included."""
    return a + i * ((b - a) / (num - 1))


def _bandwidth(n: float, d: int, method: str) -> float:
    if method == "scott":
        return n ** (-1.0 / (d + 4))
    if method == "silverman":
        return (n * (d + 2) / 4.0) ** (-1.0 / (d + 4))
    raise ValueError(method)


def kde_1d(df: DataFrame, value: str, num: int = 200, method: str = "scott",
           lo=None, hi=None) -> DataFrame:
    """Gaussian KDE with sample-variance bandwidth h (Scott or Silverman
    factor), evaluated on ``num`` points from lo to hi (default: min - std ..
    max + std).  A constant or empty column has no bandwidth: its densities
    are NULL.

    Linear binning: an observation is shared between the two cells next to
    it, cells being d = h / 16 apart; the kernel is summed over cells.  No
    density is off by more than (d/h)^2 / (8 h sqrt(2 pi)) = 0.0002 / h."""
    v = F.col(value).cast("double")
    base = df.where(v.isNotNull())
    s = base.agg(F.count(v).alias("n"), F.stddev_samp(v).alias("sd"),
                 F.min(v).alias("mn"), F.max(v).alias("mx")).first()
    n, sd = float(s["n"]), float(s["sd"] or 0)
    if sd == 0:  # fewer than two different values: no density
        return df.sparkSession.range(num).select(
            F.col("id").cast("int").alias("i"), F.lit(s["mn"]).cast("double").alias("x"),
            F.lit(None).cast("double").alias("density"))
    h = _bandwidth(n, 1, method) * sd
    a = float(s["mn"] - sd if lo is None else lo)
    b = float(s["mx"] + sd if hi is None else hi)
    step = h / CELLS_1D
    cells = _shares(base.select((v / step).alias("f0")), 1).groupBy("c0").agg(F.sum("w").alias("w"))
    at = F.col("c0") * step
    near = _reached(at, a, (b - a) / (num - 1), num, FAR * h)
    z = (linspace(F.lit(a), F.lit(b), num, F.col("i")) - at) / h
    dens = cells.select("c0", "w", F.explode(near).alias("i")).groupBy("i").agg(
        F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_s"))
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    spine = df.sparkSession.range(num).select(F.col("id").cast("int").alias("i"))
    return spine.join(F.broadcast(dens), "i", "left").select(
        "i", linspace(F.lit(a), F.lit(b), num, F.col("i")).alias("x"),
        (F.coalesce("_s", F.lit(0.0)) * norm).alias("density"))


#: Cells of the binned densities in a bandwidth, in one and two dimensions; bandwidths beyond which
#: the kernel (under 2e-14 of its height there) is left out.
CELLS_1D, CELLS_2D, FAR = 16, 8, 8


def _shares(rows: DataFrame, dims: int) -> DataFrame:
    """Linear binning of positions f0, f1, ... in cells: (c0, ..., w), each
    row shared between the cells around it."""
    for k in range(dims):
        f = F.col(f"f{k}")
        low = F.floor(f).cast("long")
        share = F.array(F.struct(low.alias("c"), (1 - (f - low)).alias("s")),
                        F.struct((low + 1).alias("c"), (f - low).alias("s")))
        kept = [c for c in rows.columns if c != f"f{k}"]
        rows = rows.select(*kept, F.inline(share)).withColumnRenamed("c", f"c{k}").withColumnRenamed("s", f"s{k}")
    w = F.lit(1.0)
    for k in range(dims):
        w = w * F.col(f"s{k}")
    return rows.select(*[f"c{k}" for k in range(dims)], w.alias("w")).where("w > 0")


def _reached(at: Column, first: float, step: float, num: int, far: float) -> Column:
    """Indices of the grid points first + i step at most ``far`` from ``at``."""
    lo = F.greatest(F.ceil((at - far - first) / step), F.lit(0)).cast("int")
    hi = F.least(F.floor((at + far - first) / step), F.lit(num - 1)).cast("int")
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def kde_2d(df: DataFrame, x: str, y: str, num: int = 100, method: str = "scott") -> DataFrame:
    """2-D Gaussian KDE (bandwidth factor times the sample covariance) on a
    num x num grid spanning [min x, max x] x [min y, max y].  If the covariance
    is singular the densities are NULL.

    With u = x + c y (c from the covariance) the kernel is a product of one
    in u and one in y.  Observations are binned linearly in (u, y), cells an
    eighth of a bandwidth apart; the kernel in y is summed from cells to grid
    rows, then the one in u from (grid row, u cell) to grid points.  Both sums
    and their shuffles have the size of the grid, whatever the rows.  No
    density is off by more than 1/256 of the height of one kernel."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.where(xv.isNotNull() & yv.isNotNull())
    s = base.agg(F.count(F.lit(1)).alias("n"), F.var_samp(xv).alias("vx"),
                 F.var_samp(yv).alias("vy"), F.covar_samp(xv, yv).alias("cxy"),
                 F.min(xv).alias("x0"), F.max(xv).alias("x1"),
                 F.min(yv).alias("y0"), F.max(yv).alias("y1")).first()
    n = float(s["n"])
    f2 = _bandwidth(n, 2, method) ** 2 if n else 0.0
    sxx, syy, sxy = (s["vx"] or 0) * f2, (s["vy"] or 0) * f2, (s["cxy"] or 0) * f2
    det = sxx * syy - sxy * sxy
    gx = linspace(F.lit(s["x0"]).cast("double"), F.lit(s["x1"]).cast("double"), num, F.col("i"))
    gy = linspace(F.lit(s["y0"]).cast("double"), F.lit(s["y1"]).cast("double"), num, F.col("j"))
    points = df.sparkSession.range(num * num).select(
        F.floor(F.col("id") / num).cast("int").alias("i"), (F.col("id") % num).cast("int").alias("j"))
    if det <= 0:  # a constant column, or one that is a line of the other
        return points.select("i", "j", gx.alias("x"), gy.alias("y"), F.lit(None).cast("double").alias("density"))
    # exp(-q/2) with q = ixx dx^2 + 2 ixy dx dy + iyy dy^2 = (du / hu)^2 + (dy / hy)^2
    ixx, ixy = syy / det, -sxy / det
    c, hu, hy = ixy / ixx, 1 / math.sqrt(ixx), math.sqrt(syy)
    du, dy = hu / CELLS_2D, hy / CELLS_2D
    cells = _shares(base.select(((xv + c * yv) / du).alias("f0"), (yv / dy).alias("f1")), 2).groupBy(
        "c0", "c1").agg(F.sum("w").alias("w"))
    at_y, at_u = F.col("c1") * dy, F.col("c0") * du
    step_x, step_y = (s["x1"] - s["x0"]) / (num - 1), (s["y1"] - s["y0"]) / (num - 1)
    zy = (gy - at_y) / hy
    rows = cells.select("c0", "c1", "w", F.explode(_reached(at_y, s["y0"], step_y, num, FAR * hy)).alias("j")).groupBy(
        "c0", "j").agg(F.sum(F.col("w") * F.exp(-0.5 * zy * zy)).alias("w"))
    zu = (gx + c * gy - at_u) / hu
    dens = rows.select("c0", "j", "w", F.explode(_reached(
        at_u - c * gy, s["x0"], step_x, num, FAR * hu)).alias("i")).groupBy("i", "j").agg(
        F.sum(F.col("w") * F.exp(-0.5 * zu * zu)).alias("_s"))
    norm = 1.0 / (n * 2 * math.pi * math.sqrt(det))
    return points.join(dens, ["i", "j"], "left").select(
        "i", "j", gx.alias("x"), gy.alias("y"), (F.coalesce("_s", F.lit(0.0)) * norm).alias("density"))


#: Distinct x that the smoother takes as they are; more go into so many buckets of equal counts.
SMOOTH_BUCKETS = 2000


def smooth(df: DataFrame, x: str, y: str, span: float = 0.75, num: int = 80,
           buckets: int = SMOOTH_BUCKETS) -> DataFrame:
    """Local quadratic regression of y on x: (i, x, y_fit) on ``num`` points
    from min x to max x.

    At each point the nearest floor(span n) observations count with tricube
    weights of their distance.  The observations are merged into buckets by
    one grouped sum of moments (powers of x, and of x times y); a bucket takes
    the weight of its mean x and keeps its exact moments, so with one x to a
    bucket the fit is that over the observations.  Everything after that sum
    has buckets x points rows.  Where fewer than three different x have
    weight, the fit is the weighted mean; no observations give no rows."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.where(xv.isNotNull() & yv.isNotNull())
    s = base.agg(F.count(F.lit(1)).alias("n"), F.min(xv).alias("lo"), F.max(xv).alias("hi")).first()
    if not s["n"]:
        return df.sparkSession.range(0).select(F.col("id").cast("int").alias("i"), F.lit(0.0).alias("x"),
                                               F.lit(0.0).alias("y_fit"))
    scale = (s["hi"] - s["lo"]) / 2 or 1.0
    z = (F.col("x") - (s["lo"] + s["hi"]) / 2) / scale  # -1..1: powers do not cancel
    merged = base.groupBy(xv.alias("x")).agg(F.count(F.lit(1)).alias("n"), F.sum(yv).alias("t"))
    merged = materialize(merged, "smooth")
    if merged.count() > buckets:
        merged = prefix_sum(merged, ["x"], "n", "upto", total="total")
        place = F.expr(f"((upto - n) * {buckets}) div total")
    else:
        place = F.col("x")
    power = lambda k: F.lit(1.0) if k == 0 else F.pow(z, F.lit(float(k)))
    b = merged.groupBy(place.alias("b")).agg(
        *[F.sum(F.col("n") * power(k)).alias(f"s{k}") for k in range(5)],
        *[F.sum(F.col("t") * power(k)).alias(f"t{k}") for k in range(3)], F.sum("n").alias("n"))
    g = F.lit(-1.0) + F.col("i") * (2.0 / (num - 1)) if s["hi"] > s["lo"] else F.lit(0.0)
    pairs = b.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(num - 1)))).withColumn(
        "d", F.abs(F.col("s1") / F.col("s0") - g))
    nearest = Window.partitionBy("i").orderBy("d").rangeBetween(Window.unboundedPreceding, 0)
    q = max(1, math.floor(span * s["n"] + 1e-5))
    reach = pairs.withColumn("upto", F.sum("n").over(nearest)).where(F.col("upto") >= q).groupBy("i").agg(
        F.min("d").alias("h"))
    ratio = F.col("d") / F.col("h")
    w = F.when(F.col("h") == 0, F.when(F.col("d") == 0, 1.0).otherwise(0.0)).when(
        ratio < 1, F.pow(1 - ratio * ratio * ratio, F.lit(3.0))).otherwise(0.0)
    sums = pairs.join(F.broadcast(reach), "i").withColumn("w", w).groupBy("i").agg(
        *[F.sum(F.col("w") * F.col(c)).alias(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")],
        F.sum((F.col("w") > 0).cast("int")).alias("used"))
    # moments about the point: the fit there is the constant term
    shift = lambda c, k: sum((math.comb(k, j) * F.pow(-g, F.lit(float(k - j))) * F.col(f"{c}{j}")
                              if k > j else F.col(f"{c}{j}") for j in range(k + 1)), F.lit(0.0))
    m = sums.select("i", "used", *[shift("s", k).alias(f"m{k}") for k in range(5)],
                    *[shift("t", k).alias(f"r{k}") for k in range(3)])
    det3 = lambda a: (F.col(a[0]) * (F.col("m2") * F.col("m4") - F.col("m3") * F.col("m3"))
                      - F.col(a[1]) * (F.col("m1") * F.col("m4") - F.col("m3") * F.col("m2"))
                      + F.col(a[2]) * (F.col("m1") * F.col("m3") - F.col("m2") * F.col("m2")))
    fit = F.when(F.col("used") < 3, F.col("r0") / F.col("m0")).otherwise(
        det3(("r0", "r1", "r2")) / F.nullif(det3(("m0", "m1", "m2")), F.lit(0.0)))
    at = linspace(F.lit(float(s["lo"])), F.lit(float(s["hi"])), num, F.col("i"))
    return m.select("i", at.alias("x"), F.coalesce(fit, F.col("r0") / F.col("m0")).alias("y_fit"))


def ecdf_grid(df: DataFrame, value: str, num: int = 100) -> DataFrame:
    """ECDF (share of observations <= x) on ``num`` points from min - std to
    max + std (population std).

    Each observation is placed in the first grid index whose point is >= it,
    counted there, and the ``num`` counts are summed cumulatively: linear in
    rows, no grid x rows product.
    """
    v = F.col(value).cast("double")
    base = df.where(v.isNotNull())
    st = base.agg(F.count(v).alias("n"), F.stddev_pop(v).alias("sd"),
                  F.min(v).alias("mn"), F.max(v).alias("mx")).first()  # one row
    n = F.lit(st["n"])
    if not st["sd"]:  # constant: the range half a unit to both sides; empty: no points
        st = {"mn": st["mn"], "mx": st["mx"], "sd": 0.5}
        if st["mn"] is None:
            return df.sparkSession.range(0).select(
                F.col("id").cast("int").alias("i"), F.lit(0.0).alias("x"), F.lit(0.0).alias("ecdf"))
    a = F.lit(st["mn"] - st["sd"])
    b = F.lit(st["mx"] + st["sd"])

    def pt(i):
        return linspace(a, b, num, i)

    i0 = F.ceil((v - a) / ((b - a) / (num - 1)))
    # correct for rounding so the placement agrees with the grid formula
    i1 = F.when(v > pt(i0), i0 + 1).otherwise(i0)
    idx = F.when((i1 > 0) & (v <= pt(i1 - 1)), i1 - 1).otherwise(i1)
    counts = base.groupBy(F.greatest(idx, F.lit(0)).cast("int").alias("i")).agg(
        F.count(F.lit(1)).alias("k"))
    spine = df.sparkSession.range(num).select(F.col("id").cast("int").alias("i"))
    cum = F.sum(F.coalesce(F.col("k"), F.lit(0))).over(
        Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))  # num rows only
    return (spine.join(F.broadcast(counts), "i", "left")
                 .select("i", pt(F.col("i")).alias("x"), (cum / n).alias("ecdf")))


def trend_line(df: DataFrame, x: str, y: str, bins: int = 20,
               decimals: int | None = None) -> DataFrame:
    """Least-squares line of y on x plus the mean of y in equal-width x bins:
    (bin, x_mid, y_mean, y_fit, n).

    With ``decimals`` (inputs carrying at most that many decimals) the moment
    sums run in DECIMAL, which is exact in any summation order; the slope and
    intercept are then the closed forms over those sums, so the result does
    not depend on partitioning.  On a constant x the line is level at the
    mean of y."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.where(xv.isNotNull() & yv.isNotNull())
    if decimals is None:
        st = base.agg(F.regr_slope(yv, xv).alias("b"), F.regr_intercept(yv, xv).alias("a"),
                      F.avg(yv).alias("ym"), F.min(xv).alias("lo"), F.max(xv).alias("hi")).first()  # one row
        lo, hi = F.lit(st["lo"]), F.lit(st["hi"])
        b = F.lit(st["b"] if st["lo"] != st["hi"] else 0.0)
        a = F.lit(st["a"] if st["lo"] != st["hi"] else st["ym"])
        y_mean = F.avg(yv)
    else:
        dt = f"decimal(30,{decimals})"
        xd, yd = F.col(x).cast(dt), F.col(y).cast(dt)
        m = base.agg(F.count(F.lit(1)).alias("n"), F.sum(xd).alias("sx"), F.sum(yd).alias("sy"),
                     F.sum(xd * xd).alias("sxx"), F.sum(xd * yd).alias("sxy"),
                     F.min(xv).alias("lo"), F.max(xv).alias("hi")).first()
        n, sx, sy, sxx, sxy = (float(m[k] or 0) for k in ("n", "sx", "sy", "sxx", "sxy"))
        spread = n * sxx - sx * sx
        slope = (n * sxy - sx * sy) / spread if spread else 0.0
        b, a = F.lit(slope), F.lit((sy - slope * sx) / n if n else 0.0)
        lo, hi = F.lit(m["lo"]), F.lit(m["hi"])
        y_mean = F.sum(yd).cast("double") / F.count(F.lit(1))
    # a constant x: the range half a unit to both sides
    lo, hi = (F.when(lo == hi, x + d).otherwise(x).cast("double") for x, d in ((lo, -0.5), (hi, 0.5)))
    width = (hi - lo) / bins
    bin_ = F.least(F.floor((xv - lo) / width), F.lit(bins - 1)).cast("int")
    g = base.groupBy(bin_.alias("bin")).agg(y_mean.alias("y_mean"),
                                           F.count(F.lit(1)).alias("n"))
    mid = lo + (F.col("bin") + 0.5) * width
    return g.select("bin", mid.alias("x_mid"), "y_mean", (a + b * mid).alias("y_fit"), "n")


def nearest_centroid(df: DataFrame, value: str, centroids: DataFrame,
                     code: str = "code", center: str = "center") -> DataFrame:
    """(row..., code, dist): index and distance of the nearest 1-D centroid.

    The codebook (k rows, k a parameter) becomes one array of distances and
    each row picks its minimum; no join.  A NULL value has no code.
    """
    book = sorted((int(r[code]), float(r[center])) for r in centroids.collect())
    arr = F.array(*[F.struct(F.abs(F.col(value).cast("double") - m).alias("d"), F.lit(c).alias("c"))
                    for c, m in book])
    # the smallest (distance, code); a NULL value has neither
    best = F.when(F.col(value).isNotNull(), F.array_min(arr))
    return df.withColumn("_b", best).select(*df.columns, F.col("_b.c").alias(code),
                                            F.col("_b.d").alias("dist"))


__all__ = ["linspace", "kde_1d", "kde_2d", "ecdf_grid", "trend_line", "smooth", "nearest_centroid"]
