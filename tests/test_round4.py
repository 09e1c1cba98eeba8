"""Jobs per boosting round, files without an exchange, and few micro-batches."""

import glob

from pyspark.sql import functions as F

from cardgrain.operators import boosting as B
from cardgrain.operators.boosting import Settings
from cardgrain.plans import explore_queries
from cardgrain.sources import files


def test_a_round_is_one_job_a_level(spark, monkeypatch):
    """The job that takes in a tree adds up the next tree's first level."""
    monkeypatch.setattr(B, "SMALL_ROWS", 10)
    df = spark.range(400).select(
        F.col("id").cast("string").alias("card_id"), F.col("id").cast("double").alias("x"),
        F.col("id").cast("double").alias("target"))
    edges = B.quantile_edges(df, ["x"], 20)
    blocks = B.blocks_of(df, "target", ["x"], edges, "card_id")
    sc = spark.sparkContext
    sc.setJobGroup("rounds", "rounds")
    try:
        model = B.train_blocks(blocks, 400, ["x"], edges, Settings(rounds=6, depth=2, bins=20), 199.5)
        jobs = len(sc.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 6 and all(len(t) == 7 for t in model.trees)
    assert jobs <= 6 * 2 + 1


def test_a_bundle_is_written_from_the_tasks_that_have_the_rows(spark, tmp_path):
    path = files.write_bundle({"a": spark.range(0, 30, 1, 3)}, str(tmp_path / "b"))
    assert len(glob.glob(f"{path}/a-*/part-*")) == 3
    assert files.read_bundle(spark, path, ["a"])["a"].count() == 30


def test_micro_batches_do_not_grow_with_the_table(spark, sf_small, tmp_path, monkeypatch):
    """Many scan partitions of transactions still land as at most a file per core."""
    monkeypatch.setattr(files, "scratch_path", lambda _, name: str(tmp_path / name))
    whole = explore_queries._r
    monkeypatch.setattr(explore_queries, "_r", lambda s, d, name: whole(s, d, name).repartition(20))
    rows = explore_queries.stream_term_hist(spark, sf_small).agg(F.sum("no_trans")).first()[0]
    assert rows == whole(spark, sf_small, "histdata").count()
    assert len(glob.glob(str(tmp_path / "stream/source/part-*"))) <= spark.sparkContext.defaultParallelism
