import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardgrain.operators import ranks


def test_group_positions_match_row_number_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [(0 if i % 3 else rnd.randint(1, 20), rnd.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, v double, i int")
    got = ranks.group_positions(df, ["g"], ["v", "i"], "pos", partitions=16)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("v", "i")))
    assert got.select("g", "i", "pos").exceptAll(ref.select("g", "i", "pos")).count() == 0
    assert got.count() == 3000


def test_global_positions(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 9, 1, 7]], "v int")
    got = {r.v: r.pos for r in ranks.global_positions(df, ["v"], partitions=3).collect()}
    assert got == {1: 1, 3: 2, 5: 3, 7: 4, 9: 5}


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    got = {r.prob: r.value for r in ranks.exact_quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    assert got == {0.25: 1.75, 0.5: 3.0, 0.75: 5.25}


def test_grouped_quantiles_and_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 10.0), (None, 20.0), ("a", None)],
                               "g string, x double")
    got = {(r.g, r.prob): r.value for r in ranks.exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == {("a", 0.5): 2.0, (None, 0.5): 15.0}


def test_dense_rank_codes_and_average_ranks(spark):
    df = spark.createDataFrame([(10,), (30,), (10,), (20,), (None,)], "v int")
    codes = sorted((r.v, r.code) for r in ranks.dense_rank_codes(df, "v", "code").collect()
                   if r.v is not None)
    assert codes == [(10, 1), (10, 1), (20, 2), (30, 3)]
    avg = sorted((r.v, r.r) for r in ranks.average_ranks(df, "v", "r").collect())
    assert avg == [(10, 1.5), (10, 1.5), (20, 3.0), (30, 4.0)]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60))
def test_quantiles_match_numpy_linear(spark, rows):
    import numpy as np
    df = spark.createDataFrame(rows, "g int, x int").selectExpr("g", "cast(x as double) x")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.value
           for r in ranks.exact_quantiles(df, "x", probs, ["g"], partitions=4).collect()}
    for g in {r[0] for r in rows}:
        xs = np.array(sorted(float(x) for gg, x in rows if gg == g))
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(xs, p)) < 1e-9


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80))
def test_positions_are_a_permutation_per_group(spark, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "g int, i int")
    got = ranks.group_positions(df, ["g"], ["i"], "pos", partitions=5).collect()
    by_g: dict[int, list[tuple[int, int]]] = {}
    for r in got:
        by_g.setdefault(r.g, []).append((r.i, r.pos))
    for g, items in by_g.items():
        items.sort()
        assert [p for _, p in items] == list(range(1, len(items) + 1))


def test_spearman_counts_a_common_value_once(spark):
    """Two thirds of the rows share a value: only distinct values are positioned,
    and no row-by-row ranking is asked of Spark ML."""
    import inspect

    from cardgrain.operators import stats
    df = spark.createDataFrame([(float(i) if i % 3 == 0 else 7.0, float(i * i % 11), 1.0)
                                for i in range(90)], "x double, y double, one double")
    assert ranks.value_positions(df, [], "x").count() == df.select("x").distinct().count()
    assert "Correlation" not in inspect.getsource(stats.spearman_long)
    got = {(r["col_a"], r["col_b"]): r["rho"] for r in stats.spearman_long(df, ["x", "y", "one"]).collect()}
    want = df.toPandas()[["x", "y"]].corr(method="spearman").loc["x", "y"]
    assert got["x", "x"] == 1.0 and abs(got["x", "y"] - want) < 1e-9 and got["y", "x"] == got["x", "y"]
    assert got["x", "one"] is None and got["one", "one"] is None


@pytest.mark.parametrize("table", [10**6, 8])
def test_spearman_equals_pandas_by_both_routes(spark, monkeypatch, table):
    """Ranks looked up, and (with room for hardly any) joined in long form."""
    from cardgrain.operators import stats
    monkeypatch.setattr(stats, "RANK_TABLE", table)
    rows = [(float(i % 13), float((i * 37) % 101) / 7, float(i % 2), float("-inf") if i % 5 else 1.0,
             None if i == 3 else 1.0 * i, float("nan") if i == 9 else 2.0 * i, 4.0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, `b.c` double, two double, inf double, gap double, nan double, one double")
    names = df.columns
    got = {(r[0], r[1]): r[2] for r in stats.spearman_long(df.repartition(5), names).collect()}
    assert len(got) == 49
    pdf = df.toPandas()
    want = pdf[["a", "b.c", "two"]].assign(inf=(pdf["inf"] == 1.0) * 1.0).corr(method="spearman")
    for x in want:
        for y in want:
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9)
    assert all(got[x, y] is None for x in names for y in ("gap", "nan", "one"))
    assert stats.spearman_long(df.where("false"), names).where("rho is not null").count() == 0


def test_spearman_of_many_columns_has_two_checkpoints(spark, monkeypatch):
    from cardgrain.operators import stats
    made = []
    real = stats.reliable_checkpoint
    monkeypatch.setattr(stats, "reliable_checkpoint", lambda df: made.append(1) or real(df))
    wide = spark.range(40).select(*[((F.col("id") * (i + 3)) % 17).alias(f"c{i}") for i in range(200)])
    out = stats.spearman_long(wide, wide.columns)
    assert out.count() == 40_000 and len(made) == 2


def test_quantiles_of_many_groups_without_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i % 5, float(i)) for i in range(50)], "g int, x double")
    want = sorted(map(tuple, ranks.exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect()))
    monkeypatch.setattr(ranks, "WANTED_ROWS", 1)
    assert sorted(map(tuple, ranks.exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect())) == want
