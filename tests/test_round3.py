"""Sources as they come, first rows by a cut, levels found in the data, one shuffle a summary."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from cardgrain import build_session  # noqa: F401
from cardgrain.operators import explore, features, profile, summaries
from cardgrain.sources import files, fixtures, schemas

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue().split("== Initial Plan ==")[0]


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(tuple(f"{round(v, 6) + 0.0:.7g}" if isinstance(v, float) else str(v) for v in (r[c] for c in cols))
                  for r in df.collect())


# -- first n ------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 7, 60, 61, 199, 200, 201, 5000])
def test_first_n_by_a_cut(spark, monkeypatch, n):
    monkeypatch.setattr(files, "SMALL_LIMIT", 0)
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 1, 1, 2, 5]), rng.randrange(9), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(4)
    got = files.first_n(df, ["a", "b", "c"], n)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))[:n]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_first_n_cut_reaches_the_scan(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "SMALL_LIMIT", 5)
    spark.range(100).select((F.col("id") / 4).cast("int").alias("a"), "id").write.parquet(str(tmp_path / "t"))
    got = files.first_n(spark.read.parquet(str(tmp_path / "t")), ["a", "id"], 41)
    assert sorted(r["id"] for r in got.collect()) == list(range(41))
    text = plan(got)
    assert "LessThan(a,10)" in text and "EqualTo(a,10)" in text and "rangepartitioning(a" not in text


# -- levels -------------------------------------------------------------------

def with_level_d(df):
    return df.withColumn("category_3", F.when(F.col("l_linenumber") == 2, "D'\\x").otherwise(F.col("category_3")))


def test_levels_come_from_the_data(spark):
    hist = with_level_d(fixtures.stored(spark, SF, "histdata"))
    assert summaries.pivot_levels(hist)["category_3"] == ["A", "B", "C", "D'\\x"]
    wide = summaries.pivot_counts(hist, "category_3")
    assert wide.columns == ["card_id", "hist_A", "hist_B", "hist_C", "hist_D'\\x"]
    n = hist.where("l_linenumber = 2").count()
    assert wide.agg(F.sum("`hist_D'\\x`")).first()[0] == n > 0
    full = summaries.hist_summary(hist)
    assert full.agg(F.sum("`hist_D'\\x`")).first()[0] == n
    new = fixtures.stored(spark, SF, "newdata").withColumn("category_2", F.when(
        F.col("l_linenumber") == 2, 9).otherwise(F.col("category_2")))
    names = summaries.new_summary(new, fixtures.stored(spark, SF, "merchants")).columns
    assert names[-4:] == ["new9", "new_A", "new_B", "new_C"]


def test_a_level_that_a_list_misses_is_an_error(spark):
    hist = with_level_d(fixtures.stored(spark, SF, "histdata"))
    with pytest.raises(Exception, match="category_3 has a level that is not listed"):
        summaries.pivot_counts(hist, "category_3", levels=["A", "B", "C"]).collect()
    with pytest.raises(Exception, match="not listed"):
        summaries.hist_summary(hist, levels=summaries.CATEGORY_LEVELS).collect()
    assert summaries.pivot_counts(hist, "category_3", levels=["A", "B", "C", "D'\\x"]).count() > 0


# -- one shuffle --------------------------------------------------------------

def test_a_summary_reads_and_shuffles_once(spark):
    hist = fixtures.stored(spark, SF, "histdata")
    text = plan(summaries.hist_summary(hist, hot_keys=summaries.NO_HOT, levels=summaries.CATEGORY_LEVELS))
    assert text.count("Scan parquet") // 2 == 1 and text.count("Exchange (") == 1


def test_features_read_each_table_few_times(spark):
    from cardgrain.plans.catalog import queries
    text = plan(queries()["train_features"](spark, SF))
    assert text.count(") Scan parquet") <= 10  # 17 before


def test_hot_cards_of_duplicate_merchants_are_told_without_the_join(spark):
    new, merchants = fixtures.stored(spark, SF, "newdata"), fixtures.stored(spark, SF, "merchants_dup")
    assert summaries.most_copies(merchants) == 2 and summaries.most_copies(merchants.where("false")) == 1
    cold, hot = (summaries.new_summary(new, merchants, hot_rows=h) for h in (10**6, 30))
    assert rows_of(cold) == rows_of(hot)


# -- merchants without a key ----------------------------------------------------

@pytest.mark.parametrize("few", [100_000, 1])
def test_missing_merchant_keys_match_each_other(spark, monkeypatch, few):
    monkeypatch.setattr(summaries, "FEW_MERCHANTS", few)
    merchants = fixtures.stored(spark, SF, "merchants")
    lone = merchants.limit(3).withColumn("merchant_id", F.lit(None).cast("long"))
    both, new = merchants.unionByName(lone), fixtures.stored(spark, SF, "newdata")
    left, right = summaries.suffix_collisions(new, both, ["merchant_id"], ("_new", "_m"))
    right = right.withColumnRenamed("merchant_id", "_k")
    want = left.join(right, left["merchant_id"].eqNullSafe(right["_k"]), "left").drop("_k")
    got = summaries.merge_merchants(new, both)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    gone = new.where("merchant_id is null").count()
    assert gone and got.where("merchant_id is null").count() == 3 * gone
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)


# -- sources --------------------------------------------------------------------

CARDS = "first_active_month,card_id,feature_1,feature_2,feature_3,target\n" + "".join(
    f"2017-0{i % 9 + 1},C_ID_{i:03d},{i % 5 + 1},{i % 3 + 1},{i % 2},{i / 10 - 2}\n" for i in range(40))
HEADER = ("authorized_flag,card_id,city_id,category_1,installments,category_3,merchant_category_id,merchant_id,"
          "month_lag,purchase_amount,purchase_date,category_2,state_id,subsector_id\n")


def transactions(seed, n):
    rng, out = random.Random(seed), [HEADER]
    for _ in range(n):
        day = dt.datetime(2017, 1, 1) + dt.timedelta(minutes=rng.randrange(400_000))
        out.append(f"{rng.choice('YN')},C_ID_{rng.randrange(40):03d},{rng.randrange(9)},{rng.choice('YN')},"
                   f"{rng.choice([0, 1, 2])},{rng.choice(['A', 'B', 'C', ''])},{rng.randrange(20)},"
                   f"{rng.choice(['M_ID_1', 'M_ID_2', ''])},{-rng.randrange(1, 9)},{rng.random():.6f},{day},"
                   f"{rng.choice(['1.0', '3.0', ''])},{rng.randrange(5)},{rng.randrange(9)}\n")
    return "".join(out)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    (d / "train.csv").write_text(CARDS)
    (d / "test.csv").write_text("\n".join(",".join(line.split(",")[:5]) for line in CARDS.splitlines()))
    (d / "historical.csv").write_text(transactions(1, 900))
    (d / "new.csv").write_text(transactions(2, 300))
    lags = ",".join(f"{w}_lag{n}" for n in (3, 6, 12) for w in ("avg_sales", "avg_purchases", "active_months"))
    (d / "merchants.csv").write_text(
        "merchant_id,merchant_group_id,merchant_category_id,subsector_id,numerical_1,numerical_2,category_1,"
        f"most_recent_sales_range,most_recent_purchases_range,{lags},category_4,city_id,state_id,category_2\n"
        "M_ID_1,1,2,3,-0.05,0.1,N,E,E,1.5,Inf,3,1,2,6,0.5,1,12,N,4,5,1.0\n"
        "M_ID_2,2,2,3,-0.05,0.1,Y,E,D,,1.25,3,1,2,6,0.5,1,12,N,4,5,\n")
    return d


def test_source_files_load_by_header_with_text_ids(spark, sources):
    train = files.read_csv(spark, str(sources / "train.csv"), schemas.SOURCE_TRAIN_CARDS)
    test = files.read_csv(spark, str(sources / "test.csv"), schemas.SOURCE_TEST_CARDS)
    hist = files.read_csv(spark, str(sources / "historical.csv"), schemas.SOURCE_TRANSACTIONS, ordinal=True)
    merchants = files.read_csv(spark, str(sources / "merchants.csv"), schemas.SOURCE_MERCHANTS)
    assert train.first()["card_id"] == "C_ID_000" and train.count() == test.count() == 40
    first = hist.orderBy(*files.SOURCE_ORDER).first()
    line = transactions(1, 900).splitlines()[1].split(",")
    assert first["card_id"] == line[1] and str(first["purchase_date"]) == line[10]
    assert {r["avg_purchases_lag3"] for r in merchants.collect()} == {float("inf"), 1.25}
    assert hist.where("category_2 = 3").count() > 0 and hist.where("merchant_id is null").count() > 0


def test_order_distance_follows_the_file(spark, sources):
    """Splits of a few lines: source order still is the file's."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        hist = files.read_csv(spark, str(sources / "historical.csv"), schemas.SOURCE_TRANSACTIONS, ordinal=True)
        assert hist.rdd.getNumPartitions() > 5
        got = {r["card_id"]: r["avg_term"] for r in summaries.order_distance(hist).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    cards = {}
    for line in transactions(1, 900).splitlines()[1:]:
        cells = line.split(",")
        cards.setdefault(cells[1], []).append(cells[10])
    for card, dates in cards.items():
        order = sorted(range(len(dates)), key=lambda i: (dates[i], i))
        steps = [abs(a - b) for a, b in zip(order[1:], order)]
        assert got[card] == pytest.approx(sum(steps) / len(steps))


def test_readme_example_runs_on_source_files(spark, sources):
    from cardgrain import card_features, fit_gbt, read_csv, rmse, score, stratified_split
    read = {n: read_csv(spark, str(sources / f"{n}.csv"), schemas.SOURCE_TRANSACTIONS, ordinal=True)
            for n in ("historical", "new")}
    train = read_csv(spark, str(sources / "train.csv"), schemas.SOURCE_TRAIN_CARDS)
    merchants = read_csv(spark, str(sources / "merchants.csv"), schemas.SOURCE_MERCHANTS)
    feats = card_features(train, read["historical"], read["new"], merchants, ref_date="2018-02-01")
    assert feats.count() == 40 and feats.where("no_trans > 0").count() == 40
    parts = stratified_split(feats, "target", p=0.8, seed=1)
    model = fit_gbt(parts.filter("part = 'train'"), rounds=3)
    preds = score(model, parts.filter("part = 'holdout'"), keep=("card_id", "target"))
    assert rmse(preds, "target", "prediction").first()["n"] == preds.count() > 0


# -- bundles --------------------------------------------------------------------

def test_a_bundle_appears_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bundle")
    a = spark.createDataFrame([(1, "x", None), (2, None, 2.5)], "i int, t string, x double")
    b = spark.range(50).toDF("id")
    files.write_bundle({"a": a, "b": b}, path)
    back = files.read_bundle(spark, path, ["a", "b"])
    assert back["a"].exceptAll(a).isEmpty() and a.exceptAll(back["a"]).isEmpty() and back["b"].count() == 50
    broken = b.select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        files.write_bundle({"a": a.limit(1), "b": broken}, path)
    assert files.read_bundle(spark, path, ["a"])["a"].count() == 2
    files.write_bundle({"a": a.limit(1)}, path)
    assert files.read_bundle(spark, path, ["a"])["a"].count() == 1
    with pytest.raises(ValueError, match="no table b"):
        files.read_bundle(spark, path, ["b"])
    with pytest.raises(ValueError, match="no table a"):
        files.read_bundle(spark, str(tmp_path / "none"), ["a"])


# -- sparse design matrix, profile ------------------------------------------------

def test_sparse_design_matrix_equals_the_dense_one(spark):
    df = spark.createDataFrame([(i, i % 3, "abcde"[i % 5], float(i % 4)) if i else (0, None, "a", 1.0)
                                for i in range(30)], "id int, f int, g string, x double")
    dense = explore.one_hot(df, ["f", "g"], keep=["id"])
    cells, columns = explore.one_hot_sparse(df, ["f", "g"], "id")
    names = {r["column"]: r["factor"] + (r["level"] or "") for r in columns.collect()}
    assert [names[i] for i in sorted(names)] == [c for c in dense.columns if c != "id"]
    got = {(r["id"], names[r["column"]]): r["value"] for r in cells.collect()}
    want = {(r["id"], c): float(r[c]) for r in dense.collect() for c in dense.columns if c != "id" and r[c]}
    assert got == want


def test_fifty_thousand_levels(spark):
    df = spark.range(60_000).select("id", (F.col("id") % 50_000).alias("f"), F.lit("k").alias("g"))
    with pytest.raises(ValueError, match="one_hot_sparse"):
        explore.one_hot(df, ["f"], keep=["id"])
    cells, columns = explore.one_hot_sparse(df, ["f", "g"], "id")
    assert columns.count() == 50_000 and cells.count() == 60_000
    assert cells.where((F.col("column") == F.col("id") % 50_000) & (F.col("value") == 1)).count() == 60_000


def test_profile_bounds_of_text_and_dates_and_head(spark, sources):
    df = spark.createDataFrame([("b", dt.date(2020, 1, 2), 3, [1]), (None, dt.date(2019, 1, 2), None, None)],
                               "t string, d date, n int, l array<int>")
    got = {r["column_name"]: (r["n_null"], r["min_value"], r["min_text"], r["max_text"])
           for r in profile.profile(df).collect()}
    assert got == {"t": (1, None, "b", "b"), "d": (0, None, "2019-01-02", "2020-01-02"), "n": (1, 3.0, "3", "3"),
                   "l": (1, None, None, None)}
    hist = files.read_csv(spark, str(sources / "historical.csv"), schemas.SOURCE_TRANSACTIONS, ordinal=True)
    want = [line.split(",")[1] for line in transactions(1, 900).splitlines()[1:7]]
    assert [r["card_id"] for r in profile.head(hist).collect()] == want
    assert features.KEY == "card_id"
