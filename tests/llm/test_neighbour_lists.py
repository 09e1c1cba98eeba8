"""Neighbour lists alone: recall with every exact route left out, and enlarged lists."""

import numpy as np
from pyspark.sql import functions as F

from cardgrain.llm import nndescent
from cardgrain.llm.common import prepare


def groups(seed, n, size, dim=32, spread=0.03):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n, dim))
    return np.concatenate([c + spread * rng.normal(size=(size, dim)) for c in centres])


def frame(spark, e):
    prepare(spark)
    return spark.createDataFrame([(i, v.tolist(), "a", v.shape[0], 1 + i % 2) for i, v in enumerate(e)],
                                 "nid long, vec array<double>, label string, dim int, copies int").withColumn(
        "bits", F.lit(int(np.ceil(np.log2(len(e) / nndescent.LEAF)))))


def lists_only(spark, e, k, grow, rounds=4):
    """Links that lists and refinement find, as near_duplicates builds them, from one pass of trees."""
    nodes, sizes, graph = frame(spark, e), None, None
    found = nndescent._join_groups(nndescent._parted(nndescent._leaves(
        nndescent._sized(nodes, None, k), 4, 0), ["label", "dim", "tree", "code"]), 0.93)
    for step in range(rounds + 1):
        lists = nndescent.materialize(found.where("sim is not null"), "lists")
        nxt = nndescent.materialize(nndescent._best(
            lists if graph is None else graph.unionByName(lists), k, sizes), "graph")
        fresh = nxt if graph is None else nndescent._changed(graph, nxt)
        graph = nxt
        if grow:
            sizes = nndescent.materialize(nndescent._saturated(graph, sizes, k, 0.93), "sizes")
        if step < rounds:
            found = nndescent._refined(nndescent._sized(nodes, sizes, k), graph, fresh, 0.93)
    links = graph.where("sim >= 0.93").select(F.least("a", "b"), F.greatest("a", "b")).distinct()
    return {tuple(r) for r in links.collect()}, sizes


def test_enlarged_lists_reach_recall_without_the_exact_routes(spark):
    e = groups(1, 30, 24)
    u = e / np.linalg.norm(e, axis=1, keepdims=True)
    near = np.triu(u @ u.T >= 0.93, 1)
    want = set(zip(*map(lambda x: x.tolist(), np.nonzero(near))))
    got, sizes = lists_only(spark, e, 4, True)
    assert got <= want and len(got) / len(want) >= 0.9
    assert sizes.agg(F.max("_size")).first()[0] > 4
    small, _ = lists_only(spark, e, 4, False)
    assert len(small) / len(want) < 0.6


def test_only_full_lists_of_links_grow(spark):
    prepare(spark)
    graph = spark.createDataFrame([(1, 2, 0.99), (1, 3, 0.98), (2, 1, 0.99), (2, 3, 0.5), (3, 1, 0.98)],
                                  "a long, b long, sim double")
    sizes = nndescent._saturated(graph, None, 2, 0.93)
    assert [tuple(r) for r in sizes.collect()] == [(1, 4)]
    more = graph.unionByName(spark.createDataFrame([(1, 4, 0.95), (1, 5, 0.94)], "a long, b long, sim double"))
    assert [tuple(r) for r in nndescent._saturated(more, sizes, 2, 0.93).collect()] == [(1, 8)]
    best = nndescent._best(more, 2, sizes)
    assert best.where("a = 1").count() == 4 and best.where("a = 3").count() == 2


def test_nodes_of_large_components_meet_their_root(spark, monkeypatch):
    prepare(spark)
    rows = spark.createDataFrame([(i, 0 if i < 400 else i // 2 * 2) for i in range(600)], "node long, root long")
    sizes = rows.groupBy("root").agg(F.count("*").alias("size"))
    got = nndescent._by_root(rows, sizes)
    assert got.count() == 600 and got.where("root = 0 and size = 400").count() == 400
    assert got.select("node").distinct().count() == 600
