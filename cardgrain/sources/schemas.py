"""Schemas of the input tables: those of the source files (``SOURCE_*``, by header, text
ids; read transactions with ``ordinal=True``) and those of the role views over the
given tables (FIXTURES.md section 1)."""

from pyspark.sql import types as T

CARDS = T.StructType([
    T.StructField("first_active_month", T.StringType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("feature_1", T.IntegerType()),
    T.StructField("feature_2", T.IntegerType()),
    T.StructField("feature_3", T.IntegerType()),
    T.StructField("target", T.DoubleType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("card_id", T.LongType()),
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("merchant_category_id", T.IntegerType()),
    T.StructField("authorized_flag", T.StringType()),
    T.StructField("category_1", T.StringType()),
    T.StructField("category_2", T.IntegerType()),
    T.StructField("category_3", T.StringType()),
    T.StructField("installments", T.IntegerType()),
    T.StructField("purchase_amount", T.DoubleType()),
    T.StructField("purchase_date", T.TimestampNTZType()),
    T.StructField("month_lag", T.IntegerType()),
])

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.LongType()),
    T.StructField("merchant_category_id", T.IntegerType()),
    T.StructField("category_1", T.StringType()),
    T.StructField("category_2", T.IntegerType()),
    T.StructField("avg_purchases_lag3", T.DoubleType()),
    T.StructField("avg_purchases_lag6", T.DoubleType()),
    T.StructField("avg_purchases_lag12", T.DoubleType()),
])


def _struct(**kinds: str) -> T.StructType:
    types = {"text": T.StringType(), "whole": T.IntegerType(), "real": T.DoubleType(), "time": T.TimestampNTZType()}
    return T.StructType([T.StructField(n, types[k]) for n, k in kinds.items()])


# The columns of the five source files.
SOURCE_TEST_CARDS = _struct(first_active_month="text", card_id="text", feature_1="whole", feature_2="whole",
                            feature_3="whole")
SOURCE_TRAIN_CARDS = T.StructType(SOURCE_TEST_CARDS.fields + [T.StructField("target", T.DoubleType())])
SOURCE_TRANSACTIONS = _struct(
    authorized_flag="text", card_id="text", city_id="whole", category_1="text", installments="whole",
    category_3="text", merchant_category_id="whole", merchant_id="text", month_lag="whole",
    purchase_amount="real", purchase_date="time", category_2="whole", state_id="whole", subsector_id="whole")
SOURCE_MERCHANTS = _struct(
    merchant_id="text", merchant_group_id="whole", merchant_category_id="whole", subsector_id="whole",
    numerical_1="real", numerical_2="real", category_1="text", most_recent_sales_range="text",
    most_recent_purchases_range="text",
    **{f"{what}_lag{n}": "whole" if what == "active_months" else "real"
       for n in (3, 6, 12) for what in ("avg_sales", "avg_purchases", "active_months")},
    category_4="text", city_id="whole", state_id="whole", category_2="whole")
