"""Per-card transaction summaries (the core of the feature table).

Each side is ONE ``groupBy("card_id").agg(...)`` with map-side partial
aggregation: the six statistics, the distinct counts, the transaction count
and span, and the category pivot counts as conditional counts. A card that
holds a third of all rows is therefore reduced inside each map task before
the shuffle.

Hot cards. Rows are first split by card size (:func:`split_hot`): a card
with more than ``hot_rows`` rows is *hot*. The set of hot cards has at most
``rows / hot_rows`` members, which bounds the broadcast used for the split.

* Cold cards (the usual case, often all cards) count distinct values with
  ``size(collect_set(x))``: one aggregate, no row expansion, and a per-card
  set that can never exceed ``hot_rows`` values. The order distance uses two
  windows over the card (bounded by ``hot_rows`` rows per group).
* Hot cards use ``count_distinct``, which Spark plans as a shuffle on
  ``(card, value)`` followed by a count -- a hot card is spread over many
  tasks -- and range-partitioned row positions for the order distance.

The one order-dependent feature, the order-permutation distance, is computed
by :func:`order_distance` and joined at card grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardgrain.functions.scalars import epoch_seconds, flag_dummy
from cardgrain.functions.selectors import quoted, select_pattern, stat_expr, suffix_collisions
from cardgrain.operators.ranks import group_positions
from cardgrain.sources.files import SOURCE_ORDER
from cardgrain.sources.fixtures import ORDINAL

KEY = "card_id"

# Fixed values that must equal the reference's: the category levels that
# become pivot columns in any case, in the reference's column order, and the names
# the new-period pivot columns are given. Levels found beside them follow.
CATEGORY_LEVELS = {
    "category_1": ["N", "Y"],
    "category_2": [1, 2, 3, 4, 5],
    "category_3": ["A", "B", "C"],
}
NEW_PIVOT_NAMES = {
    "category_1": ["new_N", "new_Y"],
    "category_2": ["new1", "new2", "new3", "new4", "new5"],
    "category_3": ["new_A", "new_B", "new_C"],
}
HIST_STAT_COLUMNS = ["purchase_amount", "month_lag", "installments", "authorized_flag"]
NEW_STAT_COLUMNS = HIST_STAT_COLUMNS + ["avg_purchases_lag3", "avg_purchases_lag6",
                                        "avg_purchases_lag12"]

# A card with more rows than this is "hot" (see module notes). It bounds the
# per-card sets of the cold path (at most 200k values per column, a few MB)
# and the rows a cold window holds in one task.
HOT_ROWS = 200_000


def hist_pivot_names(cat: str, levels: Sequence | None = None) -> list[str]:
    return [f"hist_{v}" for v in (CATEGORY_LEVELS[cat] if levels is None else levels)]


def new_pivot_names(cat: str, levels: Sequence | None = None) -> list[str]:
    known = dict(zip(CATEGORY_LEVELS[cat], NEW_PIVOT_NAMES[cat])) if cat in CATEGORY_LEVELS else {}
    return [known.get(v, f"new_{v}" if isinstance(v, str) else f"new{v}")
            for v in (CATEGORY_LEVELS[cat] if levels is None else levels)]


MOST_LEVELS = 10_000  # more columns than that are no pivot


def pivot_levels(tx: DataFrame, cats: Sequence[str] = tuple(CATEGORY_LEVELS)) -> dict[str, list]:
    """Per category the listed levels and then, sorted, all others in the data.

    One distinct pass over the categories (partial per task); over
    ``MOST_LEVELS`` levels of a category are an error.
    """
    cats = list(cats)
    long = tx.select(*[F.col(c).cast("string").alias(c) for c in cats]).unpivot([], cats, "cat", "value")
    rows = (long.where(F.col("value").isNotNull()).distinct()
            .limit((MOST_LEVELS + 1) * len(cats)).collect())
    out = {}
    for c in cats:
        kind = tx.schema[c].dataType
        whole = isinstance(kind, T.IntegralType)
        found = {int(r["value"]) if whole else r["value"] for r in rows if r["cat"] == c}
        listed = list(CATEGORY_LEVELS.get(c, []))
        out[c] = listed + sorted(found - set(listed))
        if len(out[c]) > MOST_LEVELS:
            raise ValueError(f"{c} has over {MOST_LEVELS} levels")
    return out


# ---------------------------------------------------------------------------
# Blocks (each is also its own query)
# ---------------------------------------------------------------------------

def category_counts(tx: DataFrame, cats: Sequence[str] = tuple(CATEGORY_LEVELS),
                    key: str = KEY) -> DataFrame:
    """Rows per (card, category, value); a missing value is its own group."""
    long = tx.select(key, *[F.col(c).cast("string").alias(c) for c in cats]).unpivot(
        [key], list(cats), "feature", "value")
    return long.groupBy(key, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(tx: DataFrame, cat: str, names: Sequence[str] | None = None,
                 key: str = KEY, levels: Sequence | None = None) -> DataFrame:
    """One column per level; a level a card never shows stays null.

    ``levels``: None takes those of :func:`pivot_levels`; a value of the data that
    an explicit list misses ends the job with an error. Missing values get no
    column (the reference drops the NA column by position). ``names`` name the
    first columns, further ones follow the same pattern.
    """
    strict, levels = levels is not None, list(levels) if levels is not None else pivot_levels(tx, [cat])[cat]
    pattern = new_pivot_names if names and str(names[0]).startswith("new") else hist_pivot_names
    names = [*(names or []), *pattern(cat, levels)[len(names or []):]]
    return tx.groupBy(key).agg(*pivot_exprs(cat, names, levels, strict))


def pivot_exprs(cat: str, names: Sequence[str], levels: Sequence | None = None,
                strict: bool = False) -> list[Column]:
    """The pivot as conditional counts, for use inside a fused aggregate. A ``strict`` one
    fails on a value that is not among its levels."""
    def lit(v):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    levels = CATEGORY_LEVELS[cat] if levels is None else levels
    out = [f"nullif(count_if({quoted(cat)} = {lit(v)}), 0)" for v in levels]
    if strict and out:
        known = ", ".join(map(lit, levels))
        out[0] = (f"CASE WHEN count_if({quoted(cat)} NOT IN ({known})) > 0 THEN "
                  f"raise_error({lit(f'{cat} has a level that is not listed')}) ELSE {out[0]} END")
    return [F.expr(f"{e} AS {quoted(n)}") for e, n in zip(out, names)]


def distinct_columns(df: DataFrame) -> list[str]:
    """``starts_with("merchant_")`` then ``starts_with("category")``."""
    return select_pattern(df, starts_any=("merchant_", "category"))


def distinct_expr(c: str, exact: bool = True, hot: bool = False) -> Column:
    """Distinct non-missing values of ``c`` in the group (see module notes)."""
    if not exact:
        return F.expr(f"approx_count_distinct({quoted(c)})")
    if hot:
        return F.expr(f"count(DISTINCT {quoted(c)})")
    return F.expr(f"CAST(size(collect_set({quoted(c)})) AS BIGINT)")


def distinct_exprs(df: DataFrame, exact: bool = True, hot: bool = False) -> list[Column]:
    return [distinct_expr(c, exact, hot).alias(c) for c in distinct_columns(df)]


def join_on_key(left: DataFrame, right: DataFrame, key: str = KEY, how: str = "left") -> DataFrame:
    """Join per-card blocks on the card; a missing card is a group like any other
    and meets the missing card of the other block."""
    right = right.withColumnRenamed(key, "_key")
    return left.join(right, left[key].eqNullSafe(right["_key"]), how).drop("_key")


# Passed as ``hot_keys`` when the caller already knows no key is hot.
NO_HOT = "no-hot-keys"


def hot_key_table(df: DataFrame, key: str = KEY, hot_rows: int = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, as column ``_hot`` (lazy)."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(F.col(key).alias("_hot"))


def split_hot(df: DataFrame, key: str = KEY, hot_rows: int = None, hot_keys=None):
    """``(cold rows, hot rows or None)`` by the number of rows per key.

    The hot keys are found with one partially aggregated count; when there
    are none (checked with a bounded ``isEmpty``), the input is returned
    untouched so the plan has no extra join. A caller that probed already
    passes ``hot_keys`` (a ``_hot`` table, or ``NO_HOT``).
    """
    if isinstance(hot_keys, str) and hot_keys == NO_HOT:
        return df, None
    hot = hot_keys if hot_keys is not None else hot_key_table(df, key, hot_rows)
    if hot_keys is None and hot.isEmpty():
        return df, None
    # At most rows / hot_rows keys; AQE broadcasts them if that measures small.
    cond = df[key].eqNullSafe(hot["_hot"])
    return df.join(hot, cond, "left_anti"), df.join(hot, cond, "left_semi")


def by_card_size(df: DataFrame, build, key: str = KEY, hot_rows: int = None,
                 hot_keys=None) -> DataFrame:
    """``build(rows, hot)`` on the cold rows and, if any, on the hot rows."""
    cold, hot = split_hot(df, key, hot_rows, hot_keys)
    out = build(cold, False)
    if hot is not None:
        out = out.unionByName(build(hot, True))
    return out


def distinct_counts(df: DataFrame, exact: bool = True, key: str = KEY,
                    hot_rows: int = None) -> DataFrame:
    """Distinct non-missing values per card for the pattern-chosen columns."""
    return by_card_size(df, lambda part, hot: part.groupBy(key).agg(
        *distinct_exprs(df, exact, hot)), key, hot_rows)


def with_dummy_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("authorized_flag", flag_dummy("authorized_flag"))


def fused_aggregate(df: DataFrame, key: str, aggs: list[Column], distinct: list[Column],
                    hot: bool) -> DataFrame:
    """One per-card aggregate of ``aggs`` and the distinct counts.

    On the hot path the exact distinct counts go through Spark's Expand
    plan; kept in the same aggregate, every expanded row would also carry
    all regular aggregation buffers. So hot cards get two aggregates -- the
    regular one (partially aggregated) and a distinct-only one -- joined on
    the card (hot cards are few, so that join is small).
    """
    if not hot or not distinct:
        return df.groupBy(key).agg(*aggs, *distinct)
    regular = df.groupBy(key).agg(*aggs)
    counts = df.groupBy(key).agg(*distinct)
    return join_on_key(regular, counts, key, "inner")


def stats6(df: DataFrame, columns: Sequence[str], exact: bool = True,
           key: str = KEY, hot_rows: int = None) -> DataFrame:
    """{sum, mean, min, max, sd, n_distinct} x columns, named <col>_<fn>."""
    names = [f"{c}_{fn}" for fn in ("sum", "mean", "min", "max", "sd", "n_distinct")
             for c in columns]

    def build(part: DataFrame, hot: bool) -> DataFrame:
        aggs = [stat_expr(fn, c, name=f"{c}_{fn}") for fn in ("sum", "mean", "min", "max", "sd")
                for c in columns]
        distinct = [distinct_expr(c, exact, hot).alias(f"{c}_n_distinct") for c in columns]
        return fused_aggregate(part, key, aggs, distinct, hot).select(key, *names)

    return by_card_size(df, build, key, hot_rows)


def term_exprs(prefix: str = "") -> list[Column]:
    t = epoch_seconds("purchase_date")
    return [F.count(F.lit(1)).alias(f"{prefix}no_trans"),
            (F.max(t) - F.min(t)).alias(f"{prefix}pur_term")]


def term_features(df: DataFrame, prefix: str = "", key: str = KEY) -> DataFrame:
    """Transaction count and span of purchase times (seconds) per card."""
    return df.groupBy(key).agg(*term_exprs(prefix))


def mean_gap(df: DataFrame, prefix: str = "", key: str = KEY) -> DataFrame:
    """Mean gap (seconds) between consecutive purchases: (max-min)/(n-1)."""
    t = epoch_seconds("purchase_date")
    n = F.count(t)
    return df.groupBy(key).agg(
        F.when(n > 1, (F.max(t) - F.min(t)) / (n - 1)).alias(f"{prefix}avg_gap"))


def source_order(df: DataFrame) -> list[str]:
    """The columns that order rows as in their source: those made when reading, else the fixtures'."""
    return list(SOURCE_ORDER if set(SOURCE_ORDER) <= set(df.columns) else ORDINAL)


def order_distance(df: DataFrame, name: str = "avg_term", key: str = KEY,
                   order: Sequence[str] | None = None, x: str = "purchase_date",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean absolute step of row positions when rows are sorted by ``x``.

    Positions are the rows' places in source order (``order``) within the
    card; the sort by ``x`` is stable (ties keep source order, missing last).
    Example: x = 30, 10, 20 -> positions 2, 3, 1 -> steps 1, 2 -> 1.5.

    Cards with at most ``hot_rows`` rows use two windows over the card (one
    shuffle, shared). Larger cards are split out and positioned with the
    range-partitioned helper, so no task holds a whole hot card. The set of
    hot cards has at most ``rows / hot_rows`` members, which bounds the
    broadcast used to split the input.
    """
    order = source_order(df) if order is None else list(order)
    return by_card_size(df.select(key, x, *order),
                        lambda part, hot: order_distance_part(part, hot, name, key, order, x),
                        key, hot_rows)


def order_distance_part(part: DataFrame, hot: bool, name: str = "avg_term", key: str = KEY,
                        order: Sequence[str] = tuple(ORDINAL), x: str = "purchase_date"
                        ) -> DataFrame:
    order = list(order)
    base = part.select(key, x, *order)
    if hot:
        return _order_distance_ranged(base, name, key, order, x)
    return _order_distance_window(base, name, key, order, x)


def _with_steps(base: DataFrame, key: str, order: Sequence[str], x: str) -> DataFrame:
    """Adds ``_step``: how far apart in source order a row and the one before it by ``x`` are.
    Both windows need the card's rows together, once."""
    by_source = Window.partitionBy(key).orderBy(*order)
    by_x = Window.partitionBy(key).orderBy(F.col(x).asc_nulls_last(), F.col("_idx"))
    return (base.withColumn("_idx", F.row_number().over(by_source))
            .withColumn("_step", F.abs(F.col("_idx") - F.lag("_idx").over(by_x))))


def _order_distance_window(base: DataFrame, name: str, key: str, order: list[str],
                           x: str) -> DataFrame:
    return _with_steps(base, key, order, x).groupBy(key).agg(F.avg("_step").alias(name))


def _order_distance_ranged(base: DataFrame, name: str, key: str, order: list[str],
                           x: str) -> DataFrame:
    idx = group_positions(base, [key], order, "_idx")
    q = group_positions(idx.select(key, x, "_idx"), [key],
                        [F.col(x).asc_nulls_last(), F.col("_idx")], "_q")
    prev = q.select(F.col(key).alias("_k"), (F.col("_q") + 1).alias("_qn"),
                    F.col("_idx").alias("_pidx"))
    joined = q.join(prev, q[key].eqNullSafe(prev["_k"]) & (q["_q"] == prev["_qn"]), "left")
    return joined.groupBy(key).agg(F.avg(F.abs(F.col("_idx") - F.col("_pidx"))).alias(name))


# ---------------------------------------------------------------------------
# Merchant join
# ---------------------------------------------------------------------------

FEW_MERCHANTS = 100_000  # merchants without a key that may be broadcast


def merge_merchants(new: DataFrame, merchants: DataFrame, key: str = "merchant_id",
                    suffix: tuple[str, str] = ("_new", "_m"),
                    null_keys_match: bool = True) -> DataFrame:
    """Left join of transactions to merchants; duplicate merchants fan out.

    Non-key columns present on both sides get ``suffix``. Transactions with a
    missing key match the merchants with a missing key (R's default; not with
    ``null_keys_match`` off). They skip the join, so that they never pile up in
    the one shuffle partition that null keys hash to: where there is no such
    merchant, empty columns are added to them; up to ``FEW_MERCHANTS`` (counted)
    are broadcast to them; more are copied once per shuffle partition, to meet the
    transactions dealt out by a hash of the whole row. Broadcasting the merchants with
    a key is left to AQE, which does it only when the measured size is under
    the broadcast threshold.
    """
    left, right = suffix_collisions(new, merchants, [key], suffix)
    right = right.withColumnRenamed(key, "_mkey")
    right_cols = [c for c in right.columns if c != "_mkey"]
    keyed = left.filter(F.col(key).isNotNull())
    joined = keyed.join(right, keyed[key] == right["_mkey"], "left").drop("_mkey")
    missing, lone = left.filter(F.col(key).isNull()), right.filter(F.col("_mkey").isNull())
    n = lone.limit(FEW_MERCHANTS + 1).count() if null_keys_match else 0
    if not n:
        missing = missing.select(*left.columns, *[
            F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
    else:
        salts = 1
        if n > FEW_MERCHANTS:
            salts = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        lone = lone.drop("_mkey").withColumn("_salt", F.explode(F.array(*map(F.lit, range(salts)))))
        dealt = missing.withColumn("_deal", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
        missing = dealt.join(F.broadcast(lone) if salts == 1 else lone,
                             F.col("_deal") == F.col("_salt"), "left").select(*left.columns, *right_cols)
    return joined.unionByName(missing)


# ---------------------------------------------------------------------------
# Fused summaries
# ---------------------------------------------------------------------------

def _summary(rows: DataFrame, prefix: str, columns: Sequence[str], exact: bool, key: str, hot_rows: int,
             hot_keys, pivots: list[Column]) -> DataFrame:
    """Statistics, distinct counts, terms, order distance and ``pivots`` per card.

    Cards that are not hot are shuffled once: the windows of the order distance
    and the aggregate share that partitioning. Hot cards take the fused
    aggregate (partial sums) and the ranged positions, joined on the card.
    """
    dcols, name = distinct_columns(rows), f"{prefix}avg_term"

    def build(part: DataFrame, hot: bool) -> DataFrame:
        aggs = ([stat_expr(fn, c, name=f"{c}_{fn}") for fn in ("sum", "mean", "min", "max", "sd")
                 for c in columns] + term_exprs(prefix) + pivots)
        distinct = ([distinct_expr(c, exact, hot).alias(f"{c}_n_distinct") for c in columns]
                    + [distinct_expr(c, exact, hot).alias(c) for c in dcols])
        flagged = with_dummy_flag(part)
        if hot:
            fused = fused_aggregate(flagged, key, aggs, distinct, hot)
            return join_on_key(fused, order_distance_part(part, hot, name, key, source_order(rows)), key)
        steps = _with_steps(flagged, key, source_order(rows), "purchase_date")
        return steps.groupBy(key).agg(*aggs, *distinct, F.avg("_step").alias(name))

    return by_card_size(rows, build, key, hot_rows, hot_keys)


def _columns_of(rows: DataFrame, prefix: str, columns: Sequence[str]) -> list[str]:
    return ([f"{c}_{fn}" for fn in ("sum", "mean", "min", "max", "sd", "n_distinct") for c in columns]
            + distinct_columns(rows) + [f"{prefix}no_trans", f"{prefix}pur_term", f"{prefix}avg_term"])


def hist_summary(hist: DataFrame, exact: bool = True, hot_rows: int = HOT_ROWS,
                 key: str = KEY, hot_keys=None, levels: dict[str, list] | None = None) -> DataFrame:
    """Historical per-card summary: 24 stats, distinct counts, terms, pivots.

    ``levels`` of the pivots as in :func:`pivot_counts`.
    """
    strict, levels = levels is not None, pivot_levels(hist) if levels is None else levels
    pivots = [e for cat, v in levels.items() for e in pivot_exprs(cat, hist_pivot_names(cat, v), v, strict)]
    out = _summary(hist, "", HIST_STAT_COLUMNS, exact, key, hot_rows, hot_keys, pivots)
    return out.select(key, *_columns_of(hist, "", HIST_STAT_COLUMNS),
                      *[n for cat, v in levels.items() for n in hist_pivot_names(cat, v)])


def most_copies(merchants: DataFrame, key: str = "merchant_id") -> int:
    """How often the most listed merchant is listed: no transaction fans out further."""
    return merchants.groupBy(key).count().agg(F.max("count")).first()[0] or 1


def new_summary(new: DataFrame, merchants: DataFrame, exact: bool = True,
                hot_rows: int = HOT_ROWS, null_keys_match: bool = True,
                key: str = KEY, hot_keys=None, levels: dict[str, list] | None = None) -> DataFrame:
    """New-period per-card summary.

    Pivot counts come from the transactions *before* the merchant join; all
    other blocks from the joined rows, so duplicate merchants change them. Hot
    cards are told by their transactions times the most copies of a merchant,
    so that the join is not run for the probe. ``levels`` as in :func:`hist_summary`.
    """
    if hot_keys is None:
        hot_keys = hot_key_table(new, key, hot_rows // most_copies(merchants))
        hot_keys = NO_HOT if hot_keys.isEmpty() else hot_keys
    strict, levels = levels is not None, pivot_levels(new) if levels is None else levels
    merged = merge_merchants(new, merchants, null_keys_match=null_keys_match)
    pivots = new.groupBy(key).agg(*[
        e for cat, v in levels.items() for e in pivot_exprs(cat, new_pivot_names(cat, v), v, strict)])
    out = join_on_key(_summary(merged, "new_", NEW_STAT_COLUMNS, exact, key, hot_rows, hot_keys, []),
                      pivots, key)
    return out.select(key, *_columns_of(merged, "new_", NEW_STAT_COLUMNS),
                      *[n for cat, v in levels.items() for n in new_pivot_names(cat, v)])
