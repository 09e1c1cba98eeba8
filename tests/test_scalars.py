import math

from pyspark.sql import functions as F

from cardgrain.functions import scalars as S


def test_calendar_columns(spark):
    df = spark.createDataFrame([("2017-06",), ("junk",), (None,)], "first_active_month string")
    out = S.with_calendar(df, "2018-02-01").collect()
    assert (out[0].year, out[0].month, out[0].howlong) == (2017, 6, 245)
    assert out[1].first_active_month is None and out[1].howlong is None
    assert out[2].year is None


def test_flag_dummy_keeps_missing(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,), ("x",)], "f string")
    assert [r[0] for r in df.select(S.flag_dummy("f")).collect()] == [1, 0, None, 0]


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(S.inf_to_null("v")).collect()] == [None, None, 1.5, None]


def test_fill_zero_fills_null_and_nan_keeps_inf_and_text(spark):
    df = spark.createDataFrame([(None, float("nan"), float("inf"), None, 3)],
                               "a double, b double, c double, s string, i int")
    r = S.fill_zero(df).first()
    assert r.a == 0 and r.b == 0 and math.isinf(r.c) and r.s is None and r.i == 3


def test_report_round_snaps_noise(spark):
    df = spark.createDataFrame([(46333.47875,), (46333.478749999995,), (-0.00005,), (1.23456,)],
                               "v double")
    got = [r[0] for r in df.select(S.report_round("v")).collect()]
    assert got == [46333.4788, 46333.4788, -0.0001, 1.2346]


def test_epoch_seconds_reads_ntz_as_utc(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '1970-01-02 00:00:00' AS t")
    assert df.select(S.epoch_seconds("t")).first()[0] == 86400


def test_month_text_variants(spark):
    import datetime as dt
    rows = [("2017-06",), ("2017/06",), ("2017.6",), ("201706",), ("2017-06-15",),
            ("20170615",), (" 2017-06 ",), ("junk",), ("2017-13",)]
    df = spark.createDataFrame(rows, "m string")
    got = [r[0] for r in df.select(S.year_month_to_date("m")).collect()]
    june = dt.date(2017, 6, 1)
    assert got[:4] == [june] * 4
    assert got[4] == got[5] == dt.date(2017, 6, 15)
    assert got[6] == june and got[7] is None and got[8] is None
