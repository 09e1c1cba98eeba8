import os

import duckdb
import pytest

import __spark_entry__ as E
from cardgrain.plans.catalog import queries as catalog_queries

SF = "/root/testdata/sf0.001"
RAW = ("customer orders lineitem part supplier").split()
ROWS_ONLY = {"model_gbt", "model_rf", "model_gbt_deep", "predict_test", "prediction_summary",
             "rmse_models", "model_cv"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle_unless_rows_only():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    base = set(qs) & set(catalog_queries())  # text operators are listed by their own tests
    assert base - set(sql) == ROWS_ONLY


@pytest.mark.parametrize("name", ["term_hist", "top5_ids_new", "feature_props", "target_summary",
                                  "split_stratified", "new_summary_dup"])
def test_oracle_agrees_at_small_scale(spark, name):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
    from check_oracle import rows_of

    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc and a == b
