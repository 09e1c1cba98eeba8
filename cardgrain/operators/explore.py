"""Exploration queries: each DataFrame holds the points a chart would draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.functions.scalars import inf_to_null, set_label, year_month_to_date
from cardgrain.functions.selectors import contains
from cardgrain.operators.ranks import dense_rank_codes
from cardgrain.session import reliable_checkpoint


def label_sets(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row-bind train and test by name and label each row Train/Test."""
    both = train.unionByName(test, allowMissingColumns=True)
    return both.withColumn("set", set_label("target"))


def cards_by_month_set(cards: DataFrame) -> DataFrame:
    """Cards per (first active month, set): the bars of a stacked bar chart."""
    df = cards.withColumn("first_active_month", year_month_to_date("first_active_month"))
    return df.groupBy("first_active_month", "set").agg(F.count(F.lit(1)).alias("n"))


def gather(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
           key: str = "feature", value: str = "value", cast: str | None = "string") -> DataFrame:
    """Wide -> long, keeping missing values; value columns cast to one type."""
    values = list(values if values is not None else [c for c in df.columns if c not in ids])
    if cast:
        df = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in values])
    return df.unpivot(list(ids), values, key, value)


def proportions(long: DataFrame, panel: Sequence[str], value: str = "value") -> DataFrame:
    """Share of each value in its panel (a missing value is a value).

    Both steps are partial aggregates: counts per (panel, value), then panel
    totals from those counts, joined back on the panel (null-safe). No window
    gathers a panel's values in one task.
    """
    panel = list(panel)
    counts = long.groupBy(*panel, value).agg(F.count(F.lit(1)).alias("n"))
    if not panel:
        # One panel: its total is a single scalar.
        total = counts.agg(F.sum("n")).first()[0] or 0
        return counts.select(value, "n", (F.col("n") / F.lit(float(total))).alias("prop"))
    totals = counts.groupBy(*panel).agg(F.sum("n").alias("_t"))
    totals = totals.select(*[F.col(p).alias(f"_p_{p}") for p in panel], "_t")
    cond = None
    for p in panel:
        c = counts[p].eqNullSafe(totals[f"_p_{p}"])
        cond = c if cond is None else cond & c
    out = counts.join(totals, cond, "inner")
    return out.select(*panel, value, "n", (F.col("n") / F.col("_t")).alias("prop"))


def card_feature_long(cards: DataFrame) -> DataFrame:
    """(set, feature, value) for every card feature other than ids and target."""
    df = cards.drop("first_active_month", "card_id", "target")
    return gather(df, ["set"])


def category_long(tx: DataFrame) -> DataFrame:
    cols = ["authorized_flag", "category_1", "category_2", "category_3"]
    return gather(tx.select(*cols), [])


def mean_no_skip(c: str):
    """Mean that is missing as soon as one input is missing."""
    return F.when(F.count(F.col(c)) == F.count(F.lit(1)), F.avg(c))


def top_ids_by_mean(tx: DataFrame, value: str = "purchase_amount", k: int = 5) -> DataFrame:
    """For each ``*_id`` column, the k ids with the largest mean ``value``.

    ``rank <= k`` over ``row_number`` lets Spark keep only the top k per
    partition before the shuffle (WindowGroupLimit), so each id column ships
    at most k rows per map task.
    """
    ids = [c for c in contains(tx, "_id") if c != value]
    long = gather(tx.select(*ids, value), [value], ids, "id", "value")
    means = long.groupBy("id", "value").agg(mean_no_skip(value).alias(value))
    w = Window.partitionBy("id").orderBy(F.col(value).desc_nulls_last(),
                                         F.col("value").asc_nulls_last())
    return means.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def month_target(train: DataFrame, target: str = "target") -> DataFrame:
    """Sum and mean of the target per first-active month (NA not skipped)."""
    df = train.select(year_month_to_date("first_active_month").alias("first_active_month"), target)
    return df.groupBy("first_active_month").agg(
        F.when(F.count(target) == F.count(F.lit(1)), F.sum(target)).alias(f"{target}_sum"),
        mean_no_skip(target).alias(f"{target}_mean"))


def month_trend(monthly: DataFrame, k: int = 2) -> DataFrame:
    """Long form of the monthly series with a centred moving average.

    The input is at month grain (one row per calendar month), so the window
    per series covers a bounded number of rows.
    """
    long = gather(monthly, ["first_active_month"], cast="double")
    w = (Window.partitionBy("feature").orderBy(F.col("first_active_month").asc_nulls_last())
         .rowsBetween(-k, k))
    return long.withColumn("trend", F.avg("value").over(w))


def lag_long(merchants: DataFrame) -> DataFrame:
    """(merchant_id, feature, value) for the ``*lag*`` columns, Inf -> missing."""
    lags = contains(merchants, "lag")
    long = gather(merchants.select("merchant_id", *lags), ["merchant_id"], lags, cast="double")
    return long.withColumn("value", inf_to_null("value"))


def one_hot(df: DataFrame, factors: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Design matrix without intercept: the first factor keeps all levels,
    later factors drop their first level; other columns pass through.

    Levels are the sorted distinct values of each factor column. Factor
    columns are categorical, so their level lists are small; they are read
    with a bounded ``distinct`` and checked.
    """
    df = df.dropna(how="any")
    out = [F.col(c) for c in keep]
    for i, f in enumerate(factors):
        levels = [r[0] for r in df.select(f).distinct().orderBy(f).limit(10_001).collect()]
        if len(levels) > 10_000:
            raise ValueError(f"{f} has over 10000 levels: see one_hot_sparse")
        if i > 0:
            levels = levels[1:]
        out += [F.when(F.col(f) == F.lit(v), 1).otherwise(0).alias(f"{f}{v}") for v in levels]
    rest = [c for c in df.columns if c not in set(factors) | set(keep)]
    return df.select(*out, *rest)


def one_hot_sparse(df: DataFrame, factors: Sequence[str], row: str) -> tuple[DataFrame, DataFrame]:
    """The design matrix of :func:`one_hot` as triples, for any number of levels.

    Returns ``(cells, columns)``: cells (row, column, value) without zeros, and the
    columns (column, factor, level), numbered from 0: first the factors' levels
    in order (the first factor keeps all, later ones drop their first), then the
    other columns of ``df``. Levels are numbered by distributed positions; only each
    factor's number of levels comes to the driver. Rows with a missing value are
    left out; ``row`` names the column that tells rows apart.
    """
    df, factors = df.dropna(how="any"), list(factors)
    rest = [c for c in df.columns if c not in {*factors, row}]
    long = df.select(F.col(row), *[F.col(f).cast("string").alias(f) for f in factors]).unpivot(
        [row], factors, "factor", "level")
    # Sorted as values of their type, not as text.
    levels = None
    for i, f in enumerate(factors):
        one = df.select(F.lit(i).alias("_f"), F.col(f).alias("_w")).distinct()
        one = dense_rank_codes(one, "_w", "_code").select("_f", F.col("_w").cast("string").alias("_level"), "_code")
        levels = one if levels is None else levels.unionByName(one)
    levels = reliable_checkpoint(levels)
    sizes = dict(levels.groupBy("_f").count().collect())
    start, column = 0, F.lit(None).cast("long")
    for i in range(len(factors)):
        first = 1 if i == 0 else 2
        column = F.when((F.col("_f") == i) & (F.col("_code") >= first),
                        F.col("_code") - first + start).otherwise(column)
        start += max(0, sizes.get(i, 0) - first + 1)
    names = F.array(*map(F.lit, factors))
    index = levels.select(names[F.col("_f")].alias("factor"), F.col("_level").alias("level"),
                          column.cast("long").alias("column")).where(F.col("column").isNotNull())
    cells = long.join(index, ["factor", "level"]).select(row, "column", F.lit(1.0).alias("value"))
    columns = index.select("column", "factor", "level")
    if rest:
        numbers = df.select(row, F.posexplode(F.array(*[F.col(c).cast("double") for c in rest])))
        cells = cells.unionByName(numbers.where(F.col("col") != 0).select(
            row, (F.col("pos") + start).cast("long").alias("column"), F.col("col").alias("value")))
        columns = columns.unionByName(df.sparkSession.createDataFrame(
            [(start + i, c, None) for i, c in enumerate(rest)], "column long, factor string, level string"))
    return cells, columns
