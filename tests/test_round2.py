"""A missing card on both sides of the size switch, CSV by header, stream restarts,
and boosted trees that really boost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardgrain.operators import models, summaries
from cardgrain.sources import files, fixtures
from cardgrain.streaming import card_stream

SF = "/root/testdata/sf0.001"


def rounded(df):
    cols = sorted(df.columns)
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in cols))
                  for r in df.select(cols).na.fill(-1e9).na.fill("none").collect())


def with_missing_card(df):
    return df.withColumn("card_id", F.when(F.pmod(F.xxhash64("card_id"), F.lit(3)) != 0,
                                           F.col("card_id")))


@pytest.mark.parametrize("name", ["hist_summary", "new_summary", "stats6", "order_distance"])
def test_missing_card_on_both_sides_of_the_switch(spark, name):
    hist = with_missing_card(fixtures.stored(spark, SF, "histdata"))
    new = with_missing_card(fixtures.stored(spark, SF, "newdata"))
    merchants = fixtures.stored(spark, SF, "merchants")
    build = {"hist_summary": lambda h: summaries.hist_summary(hist, hot_rows=h),
             "new_summary": lambda h: summaries.new_summary(new, merchants, hot_rows=h),
             "stats6": lambda h: summaries.stats6(hist, ["purchase_amount"], hot_rows=h),
             "order_distance": lambda h: summaries.order_distance(hist, hot_rows=h)}[name]
    cold, hot = build(10**6), build(40)
    assert cold.where("card_id is null").count() == 1
    assert rounded(cold) == rounded(hot)
    if name != "stats6":
        term = [c for c in cold.columns if c.endswith("avg_term")][0]
        assert cold.where("card_id is null").first()[term] is not None


def test_stored_transactions_keep_rows_without_a_date(spark):
    assert fixtures.stored(spark, SF, "tx").count() == fixtures.ROLES["tx"](spark, SF).count()


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "n,extra,card_id,day,x\n1.0,q,C_ID_1,2017-06-01,Inf\nNA,q,\"\",bad,-inf\n2,q,C_ID_2,,1.5\n2.5,q, ,NA,oops\n")
    schema = T.StructType([T.StructField("card_id", T.StringType()), T.StructField("day", T.DateType()),
                           T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType())])
    got = [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()]
    assert got == [("C_ID_1", dt.date(2017, 6, 1), float("inf"), 1), (None, None, float("-inf"), None),
                   ("C_ID_2", None, 1.5, 2), (None, None, None, None)]
    with pytest.raises(ValueError, match="absent"):
        files.read_csv(spark, str(tmp_path / "a.csv"), T.StructType(
            schema.fields + [T.StructField("absent", T.StringType())]))


def test_stream_restart(spark, tmp_path):
    hist = fixtures.stored(spark, SF, "histdata")
    src, table, ckpt = (str(tmp_path / x) for x in ("src", "table", "ckpt"))

    def go():
        return card_stream.run_to_table(card_stream.term_stream(
            card_stream.read_transaction_stream(spark, src, hist.schema)), table, ckpt)
    hist.where("month_lag < -3").write.parquet(src)
    first = go()
    assert go() == first  # no new files: the newest version there is
    hist.where("month_lag >= -3").write.mode("append").parquet(src)
    out = spark.read.parquet(go())
    assert out.count() == hist.select("card_id").distinct().count()
    assert out.agg(F.sum("no_trans")).first()[0] == hist.count()


def test_boosting_grows_trees_and_learns(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("card_id"), (F.col("id") % 17).alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b")).withColumn(
        "target", F.col("a") * 0.5 - F.col("b"))
    model = models.fit_gbt(df, rounds=12)
    assert len(model.trees) == 12
    pred = models.score(model, df, keep=("target",))
    sd, rmse = pred.agg(F.stddev_pop("target"), F.sqrt(F.avg(F.pow(F.col("target") - F.col("prediction"), 2)))).first()
    assert rmse < 0.7 * sd


def test_first_rounds_equal_a_model_trained_for_them(spark):
    df = spark.createDataFrame([(str(i), float(i % 7), float((i * i) % 5)) for i in range(80)],
                               "card_id string, target double, x double")
    cut = models.fit_gbt(df, rounds=6).first(2)
    few = models.fit_gbt(df, rounds=2)
    assert len(cut.trees) == 2
    assert sorted(models.score(cut, df).collect()) == sorted(models.score(few, df).collect())


def test_registered_models_train_the_library_rounds(spark, monkeypatch):
    from cardgrain.plans import model_queries as Q
    asked = []
    table = spark.createDataFrame([("a", 1.0, "train"), ("b", 2.0, "holdout")],
                                  "card_id string, target double, part string")
    monkeypatch.setattr(Q, "_MODELS", {})
    monkeypatch.setattr(Q, "_table", lambda *_: table)
    monkeypatch.setattr(models, "score", lambda model, *_, **__: model)
    for name in ("fit_gbt", "fit_rf"):
        monkeypatch.setattr(models, name, lambda *_, **kw: asked.append(kw) or "model")
    Q.model_gbt(spark, "d")
    Q.model_rf(spark, "d")
    assert Q._deep_test_predictions(spark, "d") == "model"
    assert asked == [{}, {}, {"deep": True, "patience": 50}]
    assert models.GBT_DEEP.rounds == 1000 and models.GBT_FAST.rounds == 500
