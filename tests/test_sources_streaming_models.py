import math

from pyspark.sql import functions as F

from cardgrain.operators import models as M
from cardgrain.operators import split, summaries as summ
from cardgrain.sources import files, fixtures as fx, schemas
from cardgrain.streaming import card_stream


def test_csv_reads_every_inf_spelling_and_na(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("merchant_id,merchant_category_id,category_1,category_2,avg_purchases_lag3,"
                 "avg_purchases_lag6,avg_purchases_lag12\n"
                 "1,2,Y,3,Inf,-inf,1.5\n2,NA,N,,Infinity,NA,junk\n")
    rows = files.read_csv(spark, str(p), schemas.MERCHANTS).orderBy("merchant_id").collect()
    assert math.isinf(rows[0].avg_purchases_lag3) and rows[0].avg_purchases_lag6 == float("-inf")
    assert rows[0].avg_purchases_lag12 == 1.5 and rows[0].category_2 == 3
    assert rows[1].merchant_category_id is None and rows[1].category_2 is None
    assert math.isinf(rows[1].avg_purchases_lag3) and rows[1].avg_purchases_lag6 is None
    assert rows[1].avg_purchases_lag12 is None


def test_first_n_positions_path_equals_sort_limit(spark, sf_small, monkeypatch):
    h = fx.histdata(spark, sf_small)
    small = files.first_n(h, fx.ORDINAL, 1000)
    monkeypatch.setattr(files, "SMALL_LIMIT", 10)
    big = files.first_n(h, fx.ORDINAL, 1000)
    assert big.count() == 1000
    assert small.exceptAll(big).count() == 0


def test_bundle_round_trip_keeps_rows(spark, sf_small):
    for name in ("histdata", "newdata", "merchants_dup", "train", "test"):
        raw, stored = fx.role(spark, sf_small, name), fx.stored(spark, sf_small, name)
        assert raw.columns == stored.columns
        assert raw.exceptAll(stored).count() == 0 and raw.count() == stored.count()


def test_streaming_summary_equals_batch(spark, sf_small, tmp_path):
    h = fx.histdata(spark, sf_small)
    src = str(tmp_path / "src")
    h.repartition(3).write.parquet(src)
    agg = card_stream.term_stream(card_stream.read_transaction_stream(
        spark, src, schemas.TRANSACTIONS, 1))
    out = card_stream.run_to_table(agg, str(tmp_path / "table"), str(tmp_path / "ckpt"))
    got = spark.read.parquet(out)
    want = summ.term_features(h)
    assert got.count() == want.count()
    cmp = got.select("card_id", "no_trans", "pur_term").exceptAll(
        want.select("card_id", "no_trans", "pur_term"))
    assert cmp.count() == 0


def test_folds_are_balanced_within_groups(spark, sf_small):
    f = split.stratified_folds(fx.train(spark, sf_small), "target", 5, 4, 1)
    per = f.groupBy("grp", "fold").count().groupBy("grp").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r.spread <= 1 for r in per)


def test_models_score_every_row_with_finite_predictions(spark, sf_small):
    from cardgrain.plans.catalog import _features
    feats = _features(spark, sf_small, "train")
    model = M.fit_gbt(feats, rounds=5)
    p = M.score(model, feats, keep=("card_id", "target"))
    assert p.count() == feats.count()
    assert p.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0
    rf = M.fit_rf(feats, trees=5)
    rmse = p.agg(F.sqrt(F.avg(F.pow(F.col("target") - F.col("prediction"), 2)))).first()[0]
    base = feats.agg(F.stddev_pop("target")).first()[0]
    assert rmse <= base + 1e-9
    assert M.score(rf, feats).count() == feats.count()


def test_role_views_are_saved_when_first_asked_for(spark, sf_small, tmp_path):
    import os
    folder = tmp_path / "tables"
    folder.mkdir()
    for t in ("customer", "orders", "lineitem", "part", "supplier"):
        os.symlink(f"{sf_small}/{t}.parquet", folder / f"{t}.parquet")

    def names():
        return {k[2] for k in fx._SAVED if k[1] == str(folder)}

    assert fx.stored(spark, str(folder), "train").count() == fx.train(spark, sf_small).count()
    assert names() == {"cards"}
    path = fx.saved(spark, str(folder), "cards")
    fx.stored(spark, str(folder), "test").count()
    assert fx.saved(spark, str(folder), "cards") == path and names() == {"cards"}
    hist = fx.stored(spark, str(folder), "histdata")
    assert hist.count() == fx.histdata(spark, sf_small).count()
    assert names() == {"cards", "tx"}
    assert set(fx.bundle(spark, str(folder))) == set(fx.SAVED) == names()
