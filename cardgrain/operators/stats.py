"""Distribution statistics: six-number summary, histograms, kernel density,
rank correlation, RMSE.

Only scalars (a minimum, a maximum, a count) ever travel to the driver, to
derive bin edges; all per-row work is a Spark aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.operators.ranks import count_positions, exact_quantiles
from cardgrain.session import reliable_checkpoint


# ---------------------------------------------------------------------------
# Six-number summary
# ---------------------------------------------------------------------------

def six_number_summary(df: DataFrame, col: str) -> DataFrame:
    """min, Q1, median, mean, Q3, max (quantiles linear-interpolated).

    Quantiles come from range-partitioned positions, not from a
    one-task ``percentile`` buffer.
    """
    probs = ((0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max"))
    q = exact_quantiles(df, col, [p for p, _ in probs])
    mean = df.agg(F.lit(-1.0).alias("prob"), F.avg(col).alias("value"))
    both = q.unionByName(mean)
    picks = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in probs]
    picks.append(F.max(F.when(F.col("prob") == -1.0, F.col("value"))).alias("mean"))
    return both.groupBy().agg(*picks).select("min", "q1", "median", "mean", "q3", "max")


# ---------------------------------------------------------------------------
# Histograms
# ---------------------------------------------------------------------------

def _range(df: DataFrame, col: str) -> tuple[float, float, int]:
    r = df.agg(F.min(col), F.max(col), F.count(col)).first()
    return r[0], r[1], r[2]


def _binned(df: DataFrame, col: str, origin: float, width: float, nbins: int,
            fuzz: float, n: int) -> DataFrame:
    """Counts in right-closed bins ``(origin+(k-1)w, origin+kw]`` (k = 1..nbins),
    edges nudged by ``fuzz``, the lowest edge included; empty bins kept."""
    x = F.col(col)
    k = F.greatest(F.lit(1), F.ceil((x - F.lit(fuzz) - F.lit(origin)) / F.lit(width)))
    k = F.least(k, F.lit(nbins)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(k.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    bins = spark.range(1, nbins + 1).select(F.col("id").cast("int").alias("bin"))
    out = bins.join(counts, "bin", "left").fillna(0, subset=["count"])
    xmin = F.lit(origin) + (F.col("bin") - 1) * F.lit(width)
    xmax = F.lit(origin) + F.col("bin") * F.lit(width)
    return out.select(
        "bin", xmin.alias("xmin"), xmax.alias("xmax"), ((xmin + xmax) / 2).alias("x"),
        F.col("count").cast("bigint").alias("count"),
        (F.col("count") / (F.lit(float(n)) * F.lit(width))).alias("density"))


def equal_bins(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Histogram with ``bins`` bins of width ``range / (bins - 1)`` whose
    edges sit at half-widths (the layout of a bar histogram with a bin
    count), right-closed."""
    lo, hi, n = _range(df, col)
    if n == 0:
        return _binned(df, col, 0.0, 1.0, 0, 0.0, 1)
    width = (hi - lo) / (bins - 1) if hi > lo else 0.1
    boundary = width / 2
    shift = math.floor((lo - boundary) / width)
    origin = boundary + shift * width
    max_x = hi + (1 - 1e-08) * width
    nbins = max(1, int((max_x - origin) / width + 1e-10))
    return _binned(df, col, origin, width, nbins, 1e-08 * width, n)


# The multiple of a power of ten that is a break width, and the least
# multiple of that power that the wanted width must exceed for it to be taken.
PRETTY_UNITS = ((10, 7.0), (5, 2.8), (2, 1.4), (1, 0.0))


def pretty_breaks(lo: float, hi: float, n: int = 100) -> tuple[float, float, float]:
    """(first break, last break, width) of equally spaced "pretty" breaks covering [lo, hi].

    The width is 1, 2, 5 or 10 times a power of ten, near the range over ``n``;
    breaks are its multiples. Without a range there is one interval, of a width near
    the value over ``n`` (the value 0: 1).
    """
    wanted = hi / n - lo / n
    if wanted <= max(abs(lo), abs(hi)) * np.finfo(float).eps:
        wanted = abs(hi) / n or 1.0
    power = 10.0 ** math.floor(math.log10(wanted))
    unit = power * next(m for m, above in PRETTY_UNITS if wanted / power > above)
    first, last = math.floor(lo / unit + 1e-10), math.ceil(hi / unit - 1e-10)
    return first * unit, max(last, first + 1) * unit, unit


def pretty_bins(df: DataFrame, col: str, breaks: int = 100) -> DataFrame:
    """Density histogram on "pretty" breaks: count / (N x width)."""
    lo, hi, n = _range(df, col)
    if n == 0:
        return _binned(df, col, 0.0, 1.0, 0, 0.0, 1)
    first, last, unit = pretty_breaks(lo, hi, breaks)
    nbins = max(1, int(round((last - first) / unit)))
    return _binned(df, col, first, unit, nbins, 1e-7 * unit, n)


# ---------------------------------------------------------------------------
# Kernel density on a grid
# ---------------------------------------------------------------------------

DENSITY_GRID = 512
DENSITY_CELLS = 2048


def bandwidth_nrd0(sd: float | None, iqr: float | None, n: int, first: float | None) -> float:
    """Silverman's rule of thumb: 0.9 min(sd, IQR/1.34) n^-0.2 (with the
    usual fall-backs when that minimum is zero; ``first`` is the smallest
    value, standing in for "the first value" so the result is repeatable)."""
    hi = sd if sd is not None and not math.isnan(sd) else 0.0
    lo = min(hi, (iqr or 0.0) / 1.34)
    if not lo:
        lo = hi or abs(first or 0.0) or 1.0
    return 0.9 * lo * n ** -0.2


def kernel_density(long: DataFrame, lower: float = 0.0, upper: float = 5.0,
                   grid: int = DENSITY_GRID, cells: int = DENSITY_CELLS,
                   feature: str = "feature", value: str = "value") -> DataFrame:
    """Gaussian kernel density per feature on ``grid`` points over [lower, upper].

    Values outside the limits or missing are removed first. The rows are
    reduced by Spark to counts on ``cells`` equal cells (the only per-row
    work); the bandwidth comes from each feature's count, deviation and
    interquartile range. Each feature's cell counts -- at most ``cells`` rows,
    whatever the data size -- are then convolved with the kernel on the grid
    in one pandas call per feature.
    """
    x = F.col(value)
    kept = long.filter(x.isNotNull() & (x >= lower) & (x <= upper)).select(feature, value)
    width = (upper - lower) / cells
    cell = F.least(F.floor((x - F.lit(lower)) / F.lit(width)), F.lit(cells - 1)).cast("int")
    counts = kept.groupBy(feature, cell.alias("cell")).agg(F.count(F.lit(1)).alias("cnt"))
    quart = exact_quantiles(kept, value, [0.25, 0.75], [feature])
    iqr = quart.groupBy(feature).agg(
        (F.max(F.when(F.col("prob") == 0.75, F.col("value")))
         - F.max(F.when(F.col("prob") == 0.25, F.col("value")))).alias("iqr"))
    moments = kept.groupBy(feature).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(value).alias("sd"),
        F.min(value).alias("first"))
    params = moments.join(iqr, feature, "left")
    cell_rows = counts.join(params, feature, "inner")

    def convolve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        sd = pdf["sd"].iloc[0]
        iq = pdf["iqr"].iloc[0]
        bw = bandwidth_nrd0(None if pd.isna(sd) else float(sd),
                            None if pd.isna(iq) else float(iq), n, float(pdf["first"].iloc[0]))
        mids = lower + (pdf["cell"].to_numpy() + 0.5) * width
        cnt = pdf["cnt"].to_numpy(dtype=float)
        xs = lower + (upper - lower) * np.arange(grid) / (grid - 1)
        z = (xs[:, None] - mids[None, :]) / bw
        dens = (np.exp(-0.5 * z * z) @ cnt) / (n * bw * math.sqrt(2 * math.pi))
        return pd.DataFrame({feature: pdf[feature].iloc[0], "point": np.arange(grid, dtype=np.int32),
                             "x": xs, "density": dens, "bw": bw, "n": n})

    schema = f"{feature} string, point int, x double, density double, bw double, n bigint"
    return cell_rows.groupBy(feature).applyInPandas(convolve, schema)


# ---------------------------------------------------------------------------
# Rank correlation and error
# ---------------------------------------------------------------------------

RANK_TABLE = 1_000_000   # ranks of values that every task may hold


def spearman_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spearman correlation of every pair of columns, long form (col_a, col_b, rho).

    All (column, value) pairs are counted in one aggregate. Average ranks of columns
    with few distinct values are looked up where the rows are; those of columns
    with more come from one pass over their counted values and join the rows
    once, in long form. Each task then adds up the products of centred ranks,
    and a tree-shaped sum of columns x columns numbers reaches the driver. A column
    with one value, or with a missing one (null, NaN), has no correlation.
    """
    cols = list(columns)
    values = [F.col(f"`{c}`").cast("double") for c in cols]
    base = reliable_checkpoint(df.select(
        F.array(*[F.when(~F.isnan(v), v) for v in values]).alias("_v"),
        F.monotonically_increasing_id().alias("_row")))
    long = base.select("_row", F.posexplode("_v").alias("_col", "_x")).where(F.col("_x").isNotNull())
    counts = reliable_checkpoint(long.groupBy("_col", "_x").agg(F.count("*").alias("_n")))
    n = base.count()
    sizes = {r[0]: r[1] for r in counts.groupBy("_col").agg(
        F.count("*").alias("values"), F.sum("_n").alias("rows")).where(
        (F.col("rows") == n) & (F.col("values") > 1)).select("_col", "values").collect()}
    limit = RANK_TABLE // max(1, len(cols))
    few = sorted(c for c, size in sizes.items() if size <= limit)
    many = sorted(c for c, size in sizes.items() if size > limit)
    products = _rank_products(base, long, counts, few, many, n)
    sound, at = {c: i for i, c in enumerate(few + many)}, np.sqrt(np.diag(products))
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            rho = None
            if i in sound and j in sound:
                x, y = sound[i], sound[j]
                rho = 1.0 if i == j else float(products[x, y] / (at[x] * at[y]))
            rows.append((a, b, rho))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, rho double")


def _rank_products(base: DataFrame, long: DataFrame, counts: DataFrame, few: list[int], many: list[int],
                   n: int) -> np.ndarray:
    """Sums of products of the centred ranks of the columns ``few`` + ``many``."""
    width, middle = len(few) + len(many), (n + 1) / 2.0
    if not width:
        return np.zeros((0, 0))
    tables = {c: ([], []) for c in few}
    if few:  # at most RANK_TABLE rows
        for c, x, m in counts.where(F.col("_col").isin(few)).orderBy("_col", "_x").collect():
            tables[c][0].append(x)
            tables[c][1].append(m)
    tables = [(c, np.array(x), np.cumsum(m) - np.array(m) / 2.0 + 0.5 - middle)
              for c, (x, m) in tables.items()]
    rows = base.withColumn("_ranks", F.array().cast("array<double>"))
    if many:
        ranks = count_positions(counts.where(F.col("_col").isin(many)), ["_col"], "_x").select(
            "_col", "_x", (F.col("_before") + (F.col("_n") + 1) / 2.0 - middle).alias("_rank"))
        found = (long.where(F.col("_col").isin(many)).join(ranks, ["_col", "_x"]).groupBy("_row")
                 .agg(F.sort_array(F.collect_list(F.struct("_col", "_rank"))).alias("_found")))
        rows = base.join(found, "_row").select("_v", F.col("_found._rank").alias("_ranks"))

    def add_up(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = batch.num_rows
            if m:
                v = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(m, -1)
                r = np.empty((m, width))
                for i, (c, x, rank) in enumerate(tables):
                    r[:, i] = rank[np.searchsorted(x, v[:, c])]
                if many:
                    r[:, len(few):] = batch.column(1).flatten().to_numpy().reshape(m, -1)
                total += r.T @ r
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()]})

    parts = rows.select("_v", "_ranks").mapInArrow(add_up, "total binary")
    return parts.rdd.map(lambda r: np.frombuffer(r[0]).reshape(width, width)).treeReduce(np.add)


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"),
                  F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Local regression smoother on a month-grain series
# ---------------------------------------------------------------------------

DETERMINED = 1e-9  # a fit's determinant, as a share of its diagonal's product, must be over this


def smooth_series(long: DataFrame, x: str = "first_active_month", y: str = "value",
                  series: str = "feature", points: int = 80, span: float = 0.75) -> DataFrame:
    """Local quadratic regression of each series on ``points`` equally spaced dates.

    At each point the ``span`` share of the nearest observations (three at least) sets the
    bandwidth; tricube weights, weighted least squares by its normal equations, whose sums
    are one aggregate per (series, point). Rows come at month grain, so such a group has one
    row per calendar month and the table ``points`` times as many rows as it had.

    Rows without a date or value are left out. Where the weights leave too few dates for a
    quadratic the fit is a line, then the weighted mean; where none has weight (all at the
    bandwidth's distance), the mean of those; with one or two observations, their mean.
    """
    day = F.datediff(F.col(x), F.lit("1970-01-01").cast("date")).cast("double")
    base = long.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(series).alias("_s"), day.alias("_d"), F.col(y).cast("double").alias("_y"))
    ranges = base.groupBy(F.col("_s").alias("_r")).agg(
        F.min("_d").alias("_lo"), F.max("_d").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    at = (base.join(ranges, F.col("_s").eqNullSafe(F.col("_r")))
          .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
          .withColumn("x_days", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point")
                      / F.lit(float(max(points - 1, 1))))
          .withColumn("_dist", F.abs(F.col("_d") - F.col("x_days"))))
    q = F.least(F.col("_n"), F.greatest(F.lit(3), F.floor(F.col("_n") * F.lit(float(span)))))
    group = Window.partitionBy("_s", "point")
    near = at.withColumn("_i", F.row_number().over(group.orderBy("_dist")))
    near = near.withColumn("_h", F.max(F.when(F.col("_i") == q, F.col("_dist"))).over(group))
    if span > 1:  # all observations are used; the bandwidth grows with the span
        near = near.withColumn("_h", F.col("_h") * F.lit(float(span)))
    h = F.when(F.col("_h") > 0, F.col("_h")).otherwise(F.lit(1.0))
    u = (F.col("_d") - F.col("x_days")) / h
    reach = F.least(F.col("_dist") / h, F.lit(1.0))
    rest = F.lit(1.0) - reach * reach * reach
    near = near.withColumns({"_u": u, "_w": rest * rest * rest})
    w, u, v = F.col("_w"), F.col("_u"), F.col("_y")
    sums = near.groupBy("_s", "point", "x_days", "_n").agg(
        F.sum(w).alias("_s0"), F.sum(w * u).alias("_s1"), F.sum(w * u * u).alias("_s2"),
        F.sum(w * u * u * u).alias("_s3"), F.sum(w * u * u * u * u).alias("_s4"),
        F.sum(w * v).alias("_t0"), F.sum(w * u * v).alias("_t1"),
        F.sum(w * u * u * v).alias("_t2"), F.avg(v).alias("_mean"),
        F.avg(F.when(F.col("_dist") <= h, v)).alias("_edge"))
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(f"_{c}") for c in
                                      ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))
    c0, c1, c2 = s2 * s4 - s3 * s3, s1 * s4 - s2 * s3, s1 * s3 - s2 * s2
    square, line = s0 * c0 - s1 * c1 + s2 * c2, s0 * s2 - s1 * s1
    fit = (F.when(F.col("_n") < 3, F.col("_mean"))
           .when(square > DETERMINED * s0 * s2 * s4, (t0 * c0 - t1 * c1 + t2 * c2) / square)
           .when(line > DETERMINED * s0 * s2, (t0 * s2 - t1 * s1) / line)
           .when(s0 > 0, t0 / s0).otherwise(F.col("_edge")))
    return sums.select(
        F.col("_s").alias(series), "point", "x_days", fit.alias("fit"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.floor("x_days").cast("int")).alias(x))
