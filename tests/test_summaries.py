import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cardgrain.functions.scalars import fill_zero, round_doubles
from cardgrain.operators import summaries as summ
from cardgrain.sources import fixtures as fx

TX_COLS = ("card_id bigint, l_orderkey bigint, l_linenumber int, l_partkey bigint, "
           "l_suppkey bigint, purchase_amount double, purchase_date timestamp_ntz")


def _tx(spark, card_dates):
    rows = []
    for i, (card, day) in enumerate(card_dates):
        ts = None if day is None else dt.datetime(2001, 1, 1) + dt.timedelta(days=day)
        rows.append((card, i, 1, 1, 1, 1.0, ts))
    return spark.createDataFrame(rows, TX_COLS)


@pytest.mark.parametrize("hot_rows", [summ.HOT_ROWS, 0])
def test_order_distance_examples(spark, hot_rows):
    df = _tx(spark, [(1, 30), (1, 10), (1, 20), (2, 10), (2, 10), (2, 20), (3, 10)])
    got = {r.card_id: r.avg_term for r in
           summ.order_distance(df, hot_rows=hot_rows).collect()}
    assert got[1] == 1.5
    assert got[2] == 1.0
    assert got[3] is None


def test_order_distance_missing_times_sort_last(spark):
    # times 20, NA, 10 -> order 3, 1, 2 -> steps 2, 1 -> 1.5
    df = _tx(spark, [(1, 20), (1, None), (1, 10)])
    assert summ.order_distance(df).first().avg_term == 1.5


def test_hot_path_equals_window_path(spark, sf_small):
    h = fx.histdata(spark, sf_small)
    cold = {r.card_id: r.avg_term for r in summ.order_distance(h).collect()}
    hot = {r.card_id: r.avg_term for r in summ.order_distance(h, hot_rows=20).collect()}
    assert cold.keys() == hot.keys()
    assert all((cold[k] is None and hot[k] is None) or abs(cold[k] - hot[k]) < 1e-9 for k in cold)


def test_mean_gap(spark):
    df = _tx(spark, [(1, 30), (1, 10), (1, 20), (2, 5)])
    got = {r.card_id: r.avg_gap for r in summ.mean_gap(df).collect()}
    assert got[1] == 10 * 86400 and got[2] is None


def test_six_stats_all_missing_and_inf(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, float("inf")), (2, 1.0)],
                               "card_id bigint, x double")
    out = {r.card_id: r for r in fill_zero(summ.stats6(df, ["x"])).collect()}
    a, b = out[1], out[2]
    assert (a.x_sum, a.x_mean, a.x_min, a.x_max, a.x_sd, a.x_n_distinct) == (0, 0, 0, 0, 0, 0)
    assert math.isinf(b.x_sum) and math.isinf(b.x_mean) and b.x_min == 1
    assert math.isinf(b.x_max) and b.x_sd == 0 and b.x_n_distinct == 2


def test_pivot_drops_missing_level(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (1, "A")], "card_id bigint, category_3 string")
    out = summ.pivot_counts(df, "category_3")
    assert out.columns == ["card_id", "hist_A", "hist_B", "hist_C"]
    r = out.first()
    assert r.hist_A == 2 and r.hist_B is None


def _merchant_rows(spark, keys):
    return spark.createDataFrame([(k, 7, "Y", 1, 1.0, 1.0, 1.0) for k in keys],
                                 "merchant_id bigint, merchant_category_id int, category_1 string, "
                                 "category_2 int, avg_purchases_lag3 double, "
                                 "avg_purchases_lag6 double, avg_purchases_lag12 double")


def _new_rows(spark, keys):
    return spark.createDataFrame(
        [(1, 0, 1, 1, 1, k, 3, "Y", "N", 2, "A", 1, 10.0, dt.datetime(2001, 1, 1), 0)
         for k in keys],
        "card_id bigint, l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
        "merchant_id bigint, merchant_category_id int, authorized_flag string, category_1 string, "
        "category_2 int, category_3 string, installments int, purchase_amount double, "
        "purchase_date timestamp_ntz, month_lag int")


def test_null_keys_match_only_when_asked(spark):
    new, m = _new_rows(spark, [None]), _merchant_rows(spark, [None])
    plain = summ.merge_merchants(new, m, null_keys_match=False).collect()
    assert len(plain) == 1 and plain[0].merchant_category_id_m is None
    safe = summ.merge_merchants(new, m, null_keys_match=True).collect()
    assert len(safe) == 1 and safe[0].merchant_category_id_m == 7


def test_fan_out_reaches_stats_not_pivots(spark):
    new, m = _new_rows(spark, [5]), _merchant_rows(spark, [5, 5])
    merged = summ.merge_merchants(new, m)
    assert "merchant_category_id_new" in merged.columns and "category_1_m" in merged.columns
    r = summ.new_summary(new, m).first()
    assert r.new_no_trans == 2 and r.purchase_amount_sum == 20.0
    assert r.new_N == 1 and r.new_A == 1


def test_hist_invariants_and_block_equivalence(spark, sf_small):
    h = fx.histdata(spark, sf_small)
    fused = summ.hist_summary(h)
    nulls = h.groupBy("card_id").agg(F.count_if(F.col("category_3").isNull()).alias("n3"))
    chk = fused.join(nulls, "card_id").select(
        (F.coalesce("hist_A", F.lit(0)) + F.coalesce("hist_B", F.lit(0))
         + F.coalesce("hist_C", F.lit(0)) + F.col("n3") - F.col("no_trans")).alias("d"))
    assert chk.filter("d != 0").count() == 0
    blocks = (summ.stats6(summ.with_dummy_flag(h), summ.HIST_STAT_COLUMNS)
              .join(summ.distinct_counts(h), "card_id", "left")
              .join(summ.term_features(h), "card_id", "left")
              .join(summ.order_distance(h), "card_id", "left")
              .join(summ.pivot_counts(h, "category_1"), "card_id", "left")
              .join(summ.pivot_counts(h, "category_2"), "card_id", "left")
              .join(summ.pivot_counts(h, "category_3"), "card_id", "left"))
    assert sorted(blocks.columns) == sorted(fused.columns)
    cols = [c for c in fused.columns if c != "card_id"]
    diff = fused.select("card_id", *[F.round(c, 6).alias(c) for c in cols]).exceptAll(
        blocks.select("card_id", *[F.round(c, 6).alias(c) for c in cols]))
    assert diff.count() == 0


def test_train_and_test_features_share_names(spark, sf_small):
    from cardgrain.plans.catalog import REGISTRY
    tr = REGISTRY["train_features"](spark, sf_small)
    te = REGISTRY["test_features"](spark, sf_small)
    assert [c for c in tr.columns if c != "target"] == te.columns
    assert len(tr.columns) == 114 - 1  # first_active_month dropped, card_id kept


def test_hot_and_cold_paths_agree_on_fused_summaries(spark, sf_small):
    h = fx.histdata(spark, sf_small)
    m = fx.merchants_dup(spark, sf_small)
    n = fx.newdata(spark, sf_small)
    for build in (lambda hr: summ.hist_summary(h, hot_rows=hr),
                  lambda hr: summ.new_summary(n, m, hot_rows=hr)):
        cold, hot = build(summ.HOT_ROWS), build(25)
        assert sorted(cold.columns) == sorted(hot.columns)
        a, b = round_doubles(cold, 6), round_doubles(hot, 6)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0


def test_one_card_with_a_third_of_rows(spark, sf_small):
    """A card holding a third of all rows takes the hot path while the rest
    stay cold; the mixed result equals the all-window result."""
    h = fx.histdata(spark, sf_small).withColumn(
        "card_id", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("card_id")))
    n_hot = h.filter("card_id = 1").count()
    assert n_hot > h.count() / 4
    mixed = round_doubles(summ.hist_summary(h, hot_rows=n_hot - 1), 6)
    plain = round_doubles(summ.hist_summary(h, hot_rows=10**9), 6)
    assert mixed.count() == plain.count()
    assert mixed.exceptAll(plain).count() == 0


def test_feature_table_same_with_hot_cards(spark, sf_small):
    from cardgrain.operators.features import card_features
    args = (fx.train(spark, sf_small), fx.histdata(spark, sf_small), fx.newdata(spark, sf_small),
            fx.merchants(spark, sf_small))
    cold = round_doubles(card_features(*args, ref_date="2002-01-01"), 6)
    hot = round_doubles(card_features(*args, ref_date="2002-01-01", hot_rows=25), 6)
    assert cold.columns == hot.columns
    assert cold.count() == hot.count() and cold.exceptAll(hot).count() == 0
