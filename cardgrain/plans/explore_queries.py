"""Exploration, scalar, reshape, source/sink and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardgrain.functions import scalars as S
from cardgrain.functions.selectors import select_pattern as _select_pattern
from cardgrain.operators import explore as X
from cardgrain.operators import ranks, split, stats
from cardgrain.operators.profile import profile
from cardgrain.plans.catalog import FIXTURE_REF_DATE, _r, query
from cardgrain.sources import files, schemas
from cardgrain.sources.fixtures import ORDINAL

# The reference's row cap for its transaction reads, and the
# split / fold settings.
FIRST_N = 200_000
SPLIT_P, SPLIT_GROUPS, SPLIT_SEED, SPLIT_NO = 0.8, 4, 1, 2
CV_FOLDS = 5


def _cards(spark, d):
    return X.label_sets(_r(spark, d, "train"), _r(spark, d, "test"))


# --- sources and sinks -----------------------------------------------------

@query("src_csv")
def src_csv(spark, d):
    """Merchants written to CSV by Spark, read back with the explicit schema."""
    path = files.write_csv(_r(spark, d, "merchants"), files.scratch_path(spark, "csv"))
    return files.read_csv(spark, path, schemas.MERCHANTS)


@query("src_first_n")
def src_first_n(spark, d):
    """The first 200,000 historical transactions in source order."""
    return files.first_n(_r(spark, d, "histdata"), ORDINAL, FIRST_N)


@query("src_first_n_cut")
def src_first_n_cut(spark, d):
    """The first 20,000 historical transactions in source order: a cap that cuts."""
    return files.first_n(_r(spark, d, "histdata"), ORDINAL, FIRST_N // 10)


@query("sink_roundtrip")
def sink_roundtrip(spark, d):
    """Five tables saved as one parquet bundle and loaded again: rows per table."""
    names = ["train", "test", "histdata", "newdata", "merchants"]
    path = files.write_bundle({n: _r(spark, d, n) for n in names}, files.scratch_path(spark, "bundle"))
    back = files.read_bundle(spark, path, names)
    out = None
    for n in names:
        df = back[n]
        one = df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                     F.lit(len(df.columns)).alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


@query("sink_features_csv")
def sink_features_csv(spark, d):
    """The training feature table written as CSV with a header and read back
    with its own schema (every Inf spelling accepted)."""
    from cardgrain.plans.catalog import _features

    feats = _features(spark, d, "train")
    path = files.write_csv(feats, files.scratch_path(spark, "features-csv"))
    return files.read_csv(spark, path, feats.schema)


@query("profile_table")
def profile_table(spark, d):
    """Shape and per-column missing count / min / max of the historical table."""
    return profile(_r(spark, d, "histdata")).drop("min_text", "max_text")


@query("profile_bounds")
def profile_bounds(spark, d):
    """Bounds of the historical table's text and time columns, as text."""
    h = _r(spark, d, "histdata").select("authorized_flag", "category_1", "category_3", "purchase_date")
    return profile(h).select("column_name", "n_null", "min_text", "max_text")


# --- projection and scalar functions --------------------------------------

@query("select_pattern")
def select_pattern(spark, d):
    """Columns whose name contains ``_id``, plus the purchase amount."""
    h = _r(spark, d, "histdata")
    return h.select(*_select_pattern(h, contains_any=("_id",)), "purchase_amount")


@query("card_calendar")
def card_calendar(spark, d):
    """Month text -> date, year, month, days to the reference date."""
    c = S.with_calendar(_r(spark, d, "cards"), FIXTURE_REF_DATE)
    return c.select("card_id", "first_active_month", "year", "month", "howlong")


@query("set_label")
def set_label(spark, d):
    """Train and test bound by name, labelled by whether the target is missing."""
    return _cards(spark, d)


@query("flag_dummy")
def flag_dummy(spark, d):
    h = _r(spark, d, "histdata")
    return h.select("card_id", *ORDINAL[:4], S.flag_dummy("authorized_flag").alias("authorized_flag"))


@query("lag_clean")
def lag_clean(spark, d):
    """Merchants with infinite lag values turned into missing values."""
    m = _r(spark, d, "merchants")
    return m.withColumns({c: S.inf_to_null(c) for c in m.columns if "lag" in c})


@query("fill_zero")
def fill_zero(spark, d):
    """Merchants with every missing numeric cell set to 0 (Inf kept)."""
    return S.fill_zero(_r(spark, d, "merchants"))


@query("drop_missing")
def drop_missing(spark, d):
    """Historical transactions without any missing cell."""
    return S.drop_missing(_r(spark, d, "histdata"))


@query("factor_code")
def factor_code(spark, d):
    """Per-card count and span when purchase times are read as factor codes
    (position among the sorted distinct times of the whole table)."""
    coded = ranks.dense_rank_codes(_r(spark, d, "histdata"), "purchase_date", "date_code")
    return coded.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("no_trans"),
        (F.max("date_code") - F.min("date_code")).alias("pur_term"))


# --- reshape ---------------------------------------------------------------

@query("unpivot_features")
def unpivot_features(spark, d):
    return X.card_feature_long(_cards(spark, d))


@query("unpivot_categories")
def unpivot_categories(spark, d):
    return X.category_long(_r(spark, d, "histdata"))


@query("unpivot_lags")
def unpivot_lags(spark, d):
    return X.lag_long(_r(spark, d, "merchants"))


def _one_hot(spark, d):
    t = _r(spark, d, "train").drop("first_active_month")
    return X.one_hot(t, ["feature_1", "feature_2"], keep=["card_id"])


@query("one_hot_cards")
def one_hot_cards(spark, d):
    """Design matrix of the training cards (dummy columns, no intercept)."""
    return _one_hot(spark, d)


@query("one_hot_cells")
def one_hot_cells(spark, d):
    """The same design matrix as (card, column, value) triples, without zeros."""
    t = _r(spark, d, "train").drop("first_active_month")
    return X.one_hot_sparse(t, ["feature_1", "feature_2"], "card_id")[0]


# --- aggregates and windows -------------------------------------------------

@query("cards_by_month_set")
def cards_by_month_set(spark, d):
    return X.cards_by_month_set(_cards(spark, d))


@query("feature_props")
def feature_props(spark, d):
    return X.proportions(X.card_feature_long(_cards(spark, d)), ["set", "feature"])


@query("category_props_hist")
def category_props_hist(spark, d):
    return X.proportions(X.category_long(_r(spark, d, "histdata")), ["feature"])


@query("category_props_new")
def category_props_new(spark, d):
    return X.proportions(X.category_long(_r(spark, d, "newdata")), ["feature"])


@query("top5_ids_hist")
def top5_ids_hist(spark, d):
    return X.top_ids_by_mean(_r(spark, d, "histdata"))


@query("top5_ids_new")
def top5_ids_new(spark, d):
    return X.top_ids_by_mean(_r(spark, d, "newdata"))


@query("target_by_month")
def target_by_month(spark, d):
    return X.month_target(_r(spark, d, "train"))


@query("target_trend")
def target_trend(spark, d):
    return X.month_trend(X.month_target(_r(spark, d, "train")))


@query("target_smooth")
def target_smooth(spark, d):
    """Local quadratic regression (span 0.75) of the monthly target sum and
    mean, on 80 points across the month range: the reference's trend line."""
    return stats.smooth_series(X.gather(X.month_target(_r(spark, d, "train")),
                                        ["first_active_month"], cast="double"))


@query("target_summary")
def target_summary(spark, d):
    return stats.six_number_summary(_r(spark, d, "train"), "target")


@query("target_histogram")
def target_histogram(spark, d):
    return stats.equal_bins(_r(spark, d, "train"), "target", 100)


@query("target_histogram_density")
def target_histogram_density(spark, d):
    return stats.pretty_bins(_r(spark, d, "train"), "target", 100)


@query("lag_density")
def lag_density(spark, d):
    return stats.kernel_density(X.lag_long(_r(spark, d, "merchants")), 0.0, 5.0)


@query("spearman_matrix")
def spearman_matrix(spark, d):
    m = _one_hot(spark, d)
    return stats.spearman_long(m, [c for c in m.columns if c != "card_id"])


# --- split ------------------------------------------------------------------

def _split(spark, d):
    return split.stratified_split(_r(spark, d, "train"), "target", SPLIT_P, SPLIT_GROUPS,
                                  SPLIT_SEED, SPLIT_NO)


@query("split_stratified")
def split_stratified(spark, d):
    return _split(spark, d).select("card_id", "target", "grp", "part")


@query("cv_folds")
def cv_folds(spark, d):
    f = split.stratified_folds(_r(spark, d, "train"), "target", CV_FOLDS, SPLIT_GROUPS, SPLIT_SEED)
    return f.select("card_id", "target", "grp", "fold")


@query("rmse_baseline")
def rmse_baseline(spark, d):
    """Hold-out RMSE of predicting the training part's mean target."""
    s = _split(spark, d)
    # Two scalars of the training part travel to the driver.
    mean, n_train = s.filter(F.col("part") == "train").agg(
        F.avg("target"), F.count(F.lit(1))).first()
    hold = s.filter(F.col("part") == "holdout")
    return hold.agg(
        F.lit(n_train).cast("bigint").alias("n_train"), F.lit(mean).alias("mean_train"),
        F.count(F.lit(1)).alias("n_holdout"),
        F.sqrt(F.avg(F.pow(F.col("target") - F.lit(mean), 2))).alias("rmse"))


# --- streaming ----------------------------------------------------------------

@query("stream_term_hist")
def stream_term_hist(spark, d):
    """Per-card count, span and amount statistics maintained by a Structured
    Streaming query over the historical transactions landing as files."""
    from cardgrain.streaming.card_stream import read_transaction_stream, run_to_table, term_stream

    base = files.scratch_path(spark, "stream")
    src = f"{base}/source"
    # The stream source: the historical transactions, written as parquet files, at
    # most one per core: every micro-batch updates nearly all cards, so their number
    # must not grow with the table.
    _r(spark, d, "histdata").coalesce(spark.sparkContext.defaultParallelism).write.parquet(src)
    agg = term_stream(read_transaction_stream(spark, src, schemas.TRANSACTIONS, 2))
    out = run_to_table(agg, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(out)
