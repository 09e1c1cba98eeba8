"""Centroid clustering against plain rounds over all vectors."""

import hashlib
import math

import numpy as np
import pytest

from cardgrain.llm import vafile
from cardgrain.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance long, path string"


def plain(rows, k, rounds, size):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = nearest()
        for j in range(len(centroids)):
            mine = [v for (_, v), (c, _) in zip(kept, found) if c == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = nearest()
    total = sum(d for _, d in found)
    inertia = [sum(d for c, d in found if c == j) for j in range(len(centroids))]
    return sorted((str(i), c, d, inertia[c], total,
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                  for (i, _), (c, d) in zip(kept, found))


def rows_of(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.fixture(scope="module")
def frame(spark):
    prepare(spark)
    return lambda rows, parts=3: spark.createDataFrame(
        [(i, v, "c", 1, "p") for i, v in rows], SCHEMA).repartition(parts)


def vectors(seed, n, size, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    return [(i, (centres[i % 6] + spread * rng.normal(size=size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("size", [8, 7, 64])
def test_matches_plain_rounds(frame, size):
    rows = vectors(1, 150, size)
    assert rows_of(vafile.cluster(frame(rows), k=9, rounds=3, size=size)) == plain(rows, 9, 3, size)


def test_blocks_steps_and_a_group_of_copies(frame, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 16)
    monkeypatch.setattr(vafile, "STEP", 5)
    rows = vectors(2, 80, 8, 1.0)
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    assert rows_of(vafile.cluster(frame(rows), k=7, rounds=4, size=8)) == plain(rows, 7, 4, 8)


def test_odd_rows_ties_and_repeats(frame):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.5, 0.5]), (None, [0.25, -3.0]), (None, None),
            (3, None), (4, []), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0, None]), (8, [float("nan"), 0.0]),
            (9, [float("inf"), 0.0]), (10, [0.0, float("-inf")]), (11, [0.0, -0.001]), (12, [1.0, 1.0])]
    for k in (1, 3, 40):
        assert rows_of(vafile.cluster(frame(rows), k=k, rounds=5, size=2)) == plain(rows, k, 5, 2)


def test_nothing_to_cluster(frame):
    assert rows_of(vafile.cluster(frame([(1, [1.0, 2.0])]).where("false"), size=2)) == []
    assert rows_of(vafile.cluster(frame([(1, [1.0, None])]), size=2)) == []


def test_too_large_components_end_the_job(frame):
    with pytest.raises(ValueError, match="too large"):
        vafile.cluster(frame([(1, [1e30, 0.0]), (2, [0.0, 0.0])]), size=2)


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(4)
    vecs = rng.integers(-300, 300, (400, 6))
    inner = np.sort(rng.integers(-300, 300, (6, vafile.CELLS - 1)), axis=1)
    bounds = np.hstack([vecs.min(0)[:, None], np.clip(inner, vecs.min(0)[:, None], vecs.max(0)[:, None] + 1),
                        vecs.max(0)[:, None] + 1])
    centroids = rng.integers(-400, 400, (5, 6))
    sums = vafile._intervals(vafile.to_cells(vecs, bounds), vafile._tables(bounds, centroids))
    exact = vafile.distances(vecs, centroids, np.ones((400, 5), bool))
    assert (sums[:, :5] <= exact).all() and (exact <= sums[:, 5:]).all()
    assert (sums[:, 5:] - sums[:, :5]).mean() < exact.mean()


def test_most_vectors_are_not_fetched(frame, monkeypatch):
    """Where clusters lie apart, their intervals do too."""
    rows = [(i, v) for i, v in vectors(3, 200, 64, 0.02)]
    vecs = frame(rows)
    whole = vafile.whole_vectors(vecs, 64, 256.0)
    bounds, centroids = vafile.cell_bounds(whole, 64), vafile.first_centroids(whole, 6, "2:")
    centroids = np.array([np.floor(256 * np.array(rows[i][1])) for i in range(6)], np.int64)
    for block in vafile.build(whole, bounds).collect():
        cells = np.frombuffer(block["cells"], np.uint8).reshape(block["n"], -1)
        found, fetched = vafile._assign(block["path"], cells, vafile._tables(bounds, centroids), centroids)
        assert fetched == 0 and len(found) == block["n"]
