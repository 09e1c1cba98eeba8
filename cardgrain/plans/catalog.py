"""Named queries: ``name -> builder(spark, sf_dir) -> DataFrame``.

Every builder reads the driver's tables through the role views and returns
the *report form* of an operator: floating columns rounded to 4 places so
that two engines (and two partition orders) agree on the value hash. The
library functions themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardgrain.functions.scalars import round_doubles
from cardgrain.operators import features as feat
from cardgrain.operators import summaries as summ
from cardgrain.sources import fixtures as fx

# Reference date used with the fixtures (the reference's own is 2018-02-01).
FIXTURE_REF_DATE = "2002-01-01"

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Builder] = {}


def query(name: str, rounded: bool = True):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounded else df
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def _r(spark, sf_dir, name):
    """Role view ``name`` over ``sf_dir``, read from the saved bundle."""
    return fx.stored(spark, sf_dir, name)


# --- per-card blocks -------------------------------------------------------

@query("term_hist")
def term_hist(spark, d):
    """Transaction count and purchase-time span per card (historical)."""
    return summ.term_features(_r(spark, d, "histdata"))


@query("term_new")
def term_new(spark, d):
    """Count and span per card over new transactions joined to merchants."""
    merged = summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))
    return summ.term_features(merged, "new_")


@query("term_order_hist")
def term_order_hist(spark, d):
    """Order-permutation distance per card (historical)."""
    return summ.order_distance(_r(spark, d, "histdata"), "avg_term")


@query("term_order_new")
def term_order_new(spark, d):
    merged = summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))
    return summ.order_distance(merged, "new_avg_term")


@query("term_gap_hist")
def term_gap_hist(spark, d):
    """Mean gap between consecutive purchases (seconds) per card."""
    return summ.mean_gap(_r(spark, d, "histdata"))


@query("term_gap_new")
def term_gap_new(spark, d):
    merged = summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))
    return summ.mean_gap(merged, "new_")


@query("cat_counts_hist")
def cat_counts_hist(spark, d):
    return summ.category_counts(_r(spark, d, "histdata"))


@query("cat_counts_new")
def cat_counts_new(spark, d):
    return summ.category_counts(_r(spark, d, "newdata"))


def _pivot(side: str, cat: str):
    def build(spark, d):
        names = summ.hist_pivot_names(cat) if side == "hist" else summ.NEW_PIVOT_NAMES[cat]
        return summ.pivot_counts(_r(spark, d, f"{side}data"), cat, names)
    build.__doc__ = f"Per-card counts of each {cat} level, one column per level ({side})."
    return build


for _side in ("hist", "new"):
    for _i, _cat in enumerate(summ.CATEGORY_LEVELS, start=1):
        query(f"pivot_cat{_i}_{_side}")(_pivot(_side, _cat))


@query("distinct_hist")
def distinct_hist(spark, d):
    return summ.distinct_counts(_r(spark, d, "histdata"))


@query("distinct_new")
def distinct_new(spark, d):
    merged = summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))
    return summ.distinct_counts(merged)


@query("stats6_hist")
def stats6_hist(spark, d):
    df = summ.with_dummy_flag(_r(spark, d, "histdata"))
    return summ.stats6(df, summ.HIST_STAT_COLUMNS)


@query("stats6_new")
def stats6_new(spark, d):
    merged = summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))
    return summ.stats6(summ.with_dummy_flag(merged), summ.NEW_STAT_COLUMNS)


@query("merge_merchants")
def merge_merchants(spark, d):
    """New transactions left-joined to merchants (suffixes _new / _m)."""
    return summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants"))


@query("merge_merchants_dup")
def merge_merchants_dup(spark, d):
    """The same join against a merchant table with a duplicated merchant."""
    return summ.merge_merchants(_r(spark, d, "newdata"), _r(spark, d, "merchants_dup"))


# --- fused summaries and the feature table --------------------------------

@query("hist_summary")
def hist_summary(spark, d):
    return summ.hist_summary(_r(spark, d, "histdata"))


@query("new_summary")
def new_summary(spark, d):
    return summ.new_summary(_r(spark, d, "newdata"), _r(spark, d, "merchants"))


@query("new_summary_dup")
def new_summary_dup(spark, d):
    """New summary with a duplicated merchant (fan-out reaches stats, not pivots)."""
    return summ.new_summary(_r(spark, d, "newdata"), _r(spark, d, "merchants_dup"))


def _features(spark, d, cards_role):
    return feat.card_features(_r(spark, d, cards_role), _r(spark, d, "histdata"),
                              _r(spark, d, "newdata"), _r(spark, d, "merchants"),
                              ref_date=FIXTURE_REF_DATE)


@query("train_features")
def train_features(spark, d):
    """Flagship: one row of features per training card."""
    return _features(spark, d, "train")


@query("test_features")
def test_features(spark, d):
    return _features(spark, d, "test")


def queries() -> dict[str, Builder]:
    # Importing the other plan modules registers their queries.
    from cardgrain.plans import explore_queries, model_queries  # noqa: F401
    return dict(REGISTRY)
