import hashlib
import math

import pytest
from pyspark.sql import functions as F

from cardgrain.operators import explore as X
from cardgrain.operators import split, stats
from cardgrain.sources import fixtures as fx


def test_proportions_count_missing_as_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "value string")
    got = {r.value: r.prop for r in X.proportions(df, []).collect()}
    assert got == {"a": 0.5, "b": 0.25, None: 0.25}


def test_six_number_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    r = stats.six_number_summary(df, "x").first()
    assert (r.min, r.q1, r.median, r.mean, r.q3, r.max) == (1.0, 1.75, 3.0, 4.0, 5.25, 9.0)


def test_pretty_breaks():
    assert stats.pretty_breaks(-9.99, 9.99, 100) == (-10.0, 10.0, 0.2)
    lo, hi, unit = stats.pretty_breaks(0.0, 1.0, 100)
    assert (lo, round(hi, 12), unit) == (0.0, 1.0, 0.01)


def test_histograms_keep_every_row(spark, sf_small):
    t = fx.train(spark, sf_small)
    n = t.count()
    eq = stats.equal_bins(t, "target", 100)
    assert eq.agg(F.sum("count")).first()[0] == n and eq.count() in (100, 101)
    pr = stats.pretty_bins(t, "target", 100)
    assert pr.agg(F.sum("count")).first()[0] == n
    width = pr.first().xmax - pr.first().xmin
    assert abs(pr.agg(F.sum("density")).first()[0] * width - 1) < 1e-9


def test_kernel_density_integrates_to_one(spark):
    rows = [("f", 2.0 + 0.01 * i) for i in range(100)]
    df = spark.createDataFrame(rows, "feature string, value double")
    d = stats.kernel_density(df, 0.0, 5.0).toPandas()
    step = 5.0 / 511
    assert abs(d["density"].sum() * step - 1) < 0.02


def test_split_sizes(spark, sf_small):
    t = fx.train(spark, sf_small)
    s = split.stratified_split(t, "target", 0.8, 4, 1, 1)
    per = s.groupBy("grp").agg(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col("part") == "train").alias("k")).collect()
    assert len(per) == 4
    assert all(r.k == math.ceil(0.8 * r.n) for r in per)
    again = split.stratified_split(t, "target", 0.8, 4, 1, 1)
    assert s.select("card_id", "part").exceptAll(again.select("card_id", "part")).count() == 0
    other = split.stratified_split(t, "target", 0.8, 4, 1, 2)
    assert s.select("card_id", "part").exceptAll(other.select("card_id", "part")).count() > 0


def _series(spark, name, days, values):
    import datetime as dt
    start = dt.date(2010, 1, 1)
    return spark.createDataFrame(
        [(name, None if d is None else start + dt.timedelta(days=int(d)),
          None if v is None else float(v)) for d, v in zip(days, values)],
        "feature string, first_active_month date, value double")


def _brute_fit(x, y, at, span=0.75):
    """Weighted least squares at each point, straight from the definition."""
    import numpy as np
    q = min(len(x), max(3, int(len(x) * span)))
    out = []
    for x0 in at:
        dist = np.abs(x - x0)
        h = np.sort(dist)[q - 1] * max(span, 1.0)
        w = np.sqrt((1 - np.clip(dist / h, 0, 1) ** 3) ** 3)
        out.append(np.linalg.lstsq(np.vander(x - x0, 3) * w[:, None], y * w, rcond=None)[0][2])
    return np.array(out)


def test_smoother_equals_least_squares_reproduces_quadratics_and_smooths_noise(spark):
    import numpy as np
    x = np.cumsum(np.array([31, 28, 31, 30, 31, 30] * 5)).astype(float)
    y = 0.5 * (x / 30) ** 2 - 3 * (x / 30) + 2
    noisy = y + np.random.default_rng(0).normal(0, 5, size=30)
    long = _series(spark, "exact", x, y).union(_series(spark, "noisy", x, noisy))
    for span in (0.3, 0.75, 1.5):
        got = stats.smooth_series(long, span=span).orderBy("point").toPandas()
        grid = got[got.feature == "exact"]["x_days"].to_numpy()
        at = grid - grid[0] + x[0]
        assert np.allclose(at, np.linspace(x[0], x[-1], 80))
        assert np.allclose(got[got.feature == "exact"]["fit"],
                           0.5 * (at / 30) ** 2 - 3 * (at / 30) + 2, atol=1e-6)
        fit = got[got.feature == "noisy"]["fit"].to_numpy()
        assert np.allclose(fit, _brute_fit(x, noisy, at, span), atol=1e-6)
    months = _series(spark, "noisy", x, noisy)
    smooth = stats.smooth_series(months).orderBy("point").toPandas()["fit"].to_numpy()
    true = 0.5 * (at / 30) ** 2 - 3 * (at / 30) + 2
    assert np.abs(smooth - true).mean() < np.abs(noisy - y).mean()


def test_smoother_with_few_repeated_or_missing_dates(spark):
    cases = {"one": ([5], [7.0], 7.0), "two": ([0, 10], [2.0, 4.0], 3.0),
             "same": ([3, 3, 3, 3], [1.0, 2.0, 3.0, 6.0], 3.0),
             "ends": ([0, 0, 10, 10], [1.0, 3.0, 5.0, 7.0], None)}
    long = _series(spark, "gone", [None, 4], [1.0, None])
    for name, (days, values, _) in cases.items():
        long = long.union(_series(spark, name, days, values))
    long = long.union(_series(spark, None, [0, 10], [1.0, 1.0])).withColumn("_lo", F.lit(1))
    got = stats.smooth_series(long, points=5).toPandas()
    assert set(got["feature"].dropna()) == set(cases) and len(got) == 25
    for name, (_, _, mean) in cases.items():
        fit = got[got.feature == name].sort_values("point")["fit"]
        if mean is not None:
            assert (abs(fit - mean) < 1e-9).all()
        else:  # in the middle all four are at the bandwidth's distance: their mean
            assert abs(fit.to_numpy() - [2.0, 2.0, 4.0, 6.0, 6.0]).max() < 2.01
            assert abs(fit.iloc[2] - 4.0) < 1e-9 and fit.notna().all()
    assert (got[got.feature.isna()]["fit"] == 1.0).all()
    assert stats.smooth_series(long.limit(0), points=5).count() == 0


def test_smoother_stays_in_the_engine(spark, sf_small):
    t = fx.train(spark, sf_small)
    out = stats.smooth_series(X.gather(X.month_target(t), ["first_active_month"], cast="double"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan and "Cartesian" not in plan


def test_smooth_series_points(spark, sf_small):
    t = fx.train(spark, sf_small)
    long = X.gather(X.month_target(t), ["first_active_month"], cast="double")
    out = stats.smooth_series(long)
    assert out.count() == 160
    assert out.filter(F.col("fit").isNull() | F.isnan("fit")).count() == 0


def test_kernel_density_close_to_exact_kernel_sum(spark, sf_small):
    """Binned density vs a brute-force Gaussian kernel sum over the raw values."""
    import numpy as np
    long = X.lag_long(fx.merchants(spark, sf_small))
    got = stats.kernel_density(long, 0.0, 5.0).toPandas()
    pdf = long.toPandas()
    for feat, grp in got.groupby("feature"):
        v = pdf[(pdf.feature == feat)]["value"].dropna()
        v = v[(v >= 0) & (v <= 5)].to_numpy()
        bw = grp["bw"].iloc[0]
        xs = grp.sort_values("point")["x"].to_numpy()
        exact = np.exp(-0.5 * ((xs[:, None] - v[None, :]) / bw) ** 2).sum(1) / (
            len(v) * bw * np.sqrt(2 * np.pi))
        dens = grp.sort_values("point")["density"].to_numpy()
        assert np.max(np.abs(dens - exact)) <= 0.01 * max(exact.max(), 1e-9)


def test_pretty_breaks_unit_one():
    assert stats.pretty_breaks(1.3, 98.7, 100) == (1.0, 99.0, 1.0)


def test_pretty_breaks_edges():
    assert stats.pretty_breaks(0.0, 0.0) == (0.0, 1.0, 1.0)
    lo, hi, unit = stats.pretty_breaks(-6.0, -6.0, 100)
    assert lo <= -6.0 < hi and hi - lo == pytest.approx(unit) and unit == pytest.approx(0.05)
    lo, hi, unit = stats.pretty_breaks(-9.2, -1.1, 10)
    assert lo <= -9.2 and hi >= -1.1 and unit == 1.0
    lo, hi, unit = stats.pretty_breaks(-1e300, 1e300, 100)
    assert (lo, hi, unit) == pytest.approx((-1e300, 1e300, 2e298))
    for wanted, unit in ((1.39, 1), (1.41, 2), (2.79, 2), (2.81, 5), (6.9, 5), (7.1, 10)):
        assert stats.pretty_breaks(0.0, wanted * 10, 10)[2] == pytest.approx(unit)


@pytest.mark.parametrize("few", [10_000, 3])
def test_split_by_hash_cut_equals_positions(spark, monkeypatch, few):
    """Same rows as by sorted positions, also where several passes narrow the cut."""
    monkeypatch.setattr(split, "FEW_HASHES", few)
    monkeypatch.setattr(split, "PREFIX", 1)
    df = spark.createDataFrame([(str(i), float(i * 7919 % 1000)) for i in range(500)] + [("x", None)],
                               "card_id string, target double")
    for p in (0.8, 0.0, 1.0, 0.001):
        out = split.stratified_split(df, "target", p)
        assert "Exchange rangepartitioning" not in out._jdf.queryExecution().toString()
        rows = [(r["grp"], hashlib.md5(f"1:1:{r['card_id']}".encode()).hexdigest(), r["part"]) for r in out.collect()]
        assert len(rows) == 500
        for g in range(1, 5):
            parts = [x for _, _, x in sorted(r for r in rows if r[0] == g)]
            assert parts == ["train"] * math.ceil(p * len(parts)) + ["holdout"] * (len(parts) - math.ceil(p * len(parts)))
    assert split.stratified_split(df.where("false"), "target").count() == 0
