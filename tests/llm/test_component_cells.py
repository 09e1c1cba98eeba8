"""Links of large components by cells of angles, and large leaves cut by planes, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardgrain.llm import nndescent
from cardgrain.llm.common import prepare


def unit(e):
    return e / np.linalg.norm(e, axis=1, keepdims=True)


def chain(n, dim=6):
    """Vectors whose neighbours are linked, while far ones are not."""
    turn = np.linspace(0, 6 * np.pi, n)
    e = np.zeros((n, dim))
    for i in range(0, dim, 2):
        e[:, i], e[:, i + 1] = np.cos(turn * (i + 1) / 3), np.sin(turn * (i + 1) / 3)
    return e


def dense(n, dim=6, spread=0.02):
    return np.ones(dim) + spread * np.random.default_rng(3).normal(size=(n, dim))


@pytest.mark.parametrize("kind", ["array<double>", "array<float>"])
def test_cells_count_every_link(spark, monkeypatch, kind):
    prepare(spark)
    for name, value in (("BLOCK", 16), ("CHUNK", 48), ("EXACT", 24)):
        monkeypatch.setattr(nndescent, name, value)
    e = np.concatenate([chain(150), dense(120), [[1.0, 2, 0, 0, 0, 0], [1, 2.1, 0, 0, 0, 0], [1, 2.2, 0, 0, 0, 0]]])
    if kind == "array<float>":
        e = e.astype(np.float32).astype(np.float64)
    group = [0] * 150 + [150] * 120 + [270] * 3
    copies = [1 + i % 3 for i in range(len(e))]
    nodes = spark.createDataFrame([(i, c, v.tolist()) for i, (c, v) in enumerate(zip(copies, e))],
                                  "nid long, copies long, vec array<double>") \
        .withColumn("vec", F.col("vec").cast(kind))
    roots = spark.createDataFrame(list(enumerate(group)), "node long, root long")
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    got = {r["nid"]: r["links"] for r in nndescent._component_counts(nodes, roots, sizes, 0.93).collect()}
    near = unit(e) @ unit(e).T >= 0.93
    np.fill_diagonal(near, False)
    near &= np.array(group)[:, None] == np.array(group)[None, :]
    assert got == dict(enumerate((near @ np.array(copies)).tolist()))


def test_a_dense_component_is_counted_without_comparing_pairs(spark, monkeypatch):
    """Where every angle is far below the threshold, no node visits a cell."""
    prepare(spark)
    seen = []
    keep = nndescent.materialize
    monkeypatch.setattr(nndescent, "materialize", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    e = dense(700)
    members = spark.createDataFrame([(0, i, 1, v.tolist(), len(e)) for i, v in enumerate(e)],
                                    "root long, nid long, copies long, vec array<double>, size long")
    got = nndescent._cell_counts(members, 0.93).collect()
    assert len(got) == 700 and all(r["links"] == 699 for r in got)
    assert dict(seen)["decided"].where("cell is not null").count() == 0


def test_large_leaves_are_cut_by_planes(spark, monkeypatch):
    """Groups end below the limit, lose no member, and keep most near pairs together."""
    prepare(spark)
    monkeypatch.setattr(nndescent, "GROUP", 64)
    rng = np.random.default_rng(5)
    centres = dense(40, 16, 0.2)
    e = np.concatenate([c + 0.002 * rng.normal(size=(12, 16)) for c in centres])
    members = spark.createDataFrame([("x", i, v.tolist(), 8) for i, v in enumerate(e)],
                                    "leaf string, nid long, vec array<double>, k int")
    got = {r["nid"]: r["grp"] for r in nndescent._parted(members, ["leaf"]).select("nid", "grp").collect()}
    assert sorted(got) == list(range(len(e)))
    sizes = np.unique(list(got.values()), return_counts=True)[1]
    assert sizes.max() <= 64
    together = [got[12 * g + i] == got[12 * g + i + 1] for g in range(40) for i in range(11)]
    assert np.mean(together) > 0.8
    few = nndescent._parted(members.where("nid < 20"), ["leaf"]).select("grp").distinct().collect()
    assert [r["grp"] for r in few] == ["x"]


def test_equal_directions_are_cut_by_hash_at_last(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(nndescent, "GROUP", 16)
    members = spark.createDataFrame([("x", i, [float(i + 1), 0.0], 8) for i in range(100)],
                                    "leaf string, nid long, vec array<double>, k int")
    got = nndescent._parted(members, ["leaf"]).groupBy("grp").count().collect()
    assert sum(r["count"] for r in got) == 100 and len(got) > 3
