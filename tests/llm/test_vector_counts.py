"""Links inside a component are all counted, however few its lists met."""

from cardgrain.llm import nndescent


def test_links_of_a_small_component_are_compared_whole(spark):
    vec = [[1.0, 0.0], [1.0, 0.1], [1.0, 0.2]]
    nodes = spark.createDataFrame([(i, 1, v) for i, v in enumerate(vec)],
                                  "nid long, copies long, vec array<double>")
    links = spark.createDataFrame([(0, 1, 0.99), (1, 2, 0.99)], "a long, b long, sim double")
    roots = spark.createDataFrame([(i, 0) for i in range(3)], "node long, root long")
    counts, dense = nndescent._counts(nodes, links, roots, threshold=0.93)
    assert {r["nid"]: r["links"] for r in counts.collect()} == {0: 2, 1: 2, 2: 2}
    assert [tuple(r) for r in dense.collect()] == [(0, 3)]
