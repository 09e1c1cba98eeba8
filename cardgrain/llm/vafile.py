"""Centroid clustering over a vector-approximation file.

Vectors are written once, in blocks, into the shared folder. What the rounds scan
is a table of their approximations: one of ``2 ** CELL_BITS`` cells per component, a
byte each, against 4 bytes in the block. For each centroid two lookup tables (lowest
and highest squared distance of any point in a cell) add up to an interval that
holds the vector's distance. Where one centroid's interval ends before all others
begin, the nearest centroid is known; else the full vector is fetched from its
block and measured against the centroids whose intervals overlap. Centroids are
exact all the same: sums are corrected by the vectors that changed their cluster,
which are fetched too.

All numbers are whole, so results do not depend on partitions or their order.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, discard, materialize, shared_path
from cardgrain.llm.files import read_spans, write_file

CELL_BITS = 7        # up to 8
CELLS = 1 << CELL_BITS
BLOCK = 1 << 16      # vectors a block, 16 MB of 64 components
STEP = 2048          # vectors measured at once
LARGEST = 1 << 26    # of a whole component: squared distances stay below 2**63
NONE = 65535         # no cluster yet


def whole_vectors(table: DataFrame, size: int, scale: float) -> DataFrame:
    """(vec_id, vec): vectors of exactly ``size`` finite components, as floor(scale * x)."""
    good = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)))
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where((F.size("embedding") == size) & good)
            .select("vec_id", whole.alias("vec")))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of salt and id (ties: smaller components)."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "vec").orderBy("key", "vec").limit(k).collect()
    return np.array([r["vec"] for r in rows], np.int64)


def cell_bounds(vectors: DataFrame, size: int) -> np.ndarray:
    """Per component: the smallest value, ``CELLS`` - 1 inner bounds (even steps over three
    standard deviations to each side of the mean) and the largest value plus 1."""
    rows = (vectors.select(F.posexplode("vec").alias("dim", "x")).groupBy("dim")
            .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"),
                 F.stddev_pop("x").alias("spread")).collect())
    cuts = np.linspace(-3, 3, CELLS - 1)
    bounds = np.zeros((size, CELLS + 1), np.int64)
    for r in rows:
        if max(abs(r["low"]), abs(r["high"])) > LARGEST:
            raise ValueError(f"component {r['dim']} is too large: distances would not fit 64 bits")
        inner = np.round(r["mean"] + (r["spread"] or 0.0) * cuts).astype(np.int64)
        bounds[r["dim"]] = [r["low"], *np.clip(inner, r["low"], r["high"] + 1), r["high"] + 1]
    return bounds


def to_cells(vecs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(bounds[j, 1:-1], vecs[:, j], side="right")
                     for j in range(len(bounds))], axis=1).astype(np.uint8)


def build(vectors: DataFrame, bounds: np.ndarray) -> DataFrame:
    """Writes the blocks; a row per block: path, n, cells (``size`` bytes a vector), no clusters."""
    size, root = len(bounds), shared_path(vectors.sparkSession, "vectors")

    def block(ids, vecs):
        vecs = np.array(vecs, np.int64)
        path = f"{root}/{uuid.uuid4().hex}"
        named = np.array([x is not None for x in ids], np.uint8)
        write_file(path, vecs.astype("<i4").tobytes()
                   + np.array([x or 0 for x in ids], "<i8").tobytes() + named.tobytes())
        return {"path": [path], "n": [len(ids)], "cells": [to_cells(vecs, bounds).tobytes()],
                "clusters": [np.full(len(ids), NONE, "<u2").tobytes()], "delta": [b""]}

    def run(batches):
        ids, vecs = [], []
        for batch in batches:
            ids += batch["vec_id"]
            vecs += batch["vec"]
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], vecs[:BLOCK])
                ids, vecs = ids[BLOCK:], vecs[BLOCK:]
        if ids:
            yield block(ids, vecs)

    return arrow_map(vectors, run, _BLOCKS)


_BLOCKS = "path string, n long, cells binary, clusters binary, delta binary"


def _tables(bounds: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """[component, cell, 2k]: the lowest, then the highest squared differences to the k
    centroids that a component in that cell can add."""
    low, high = bounds[:, :-1], np.maximum(bounds[:, 1:] - 1, bounds[:, :-1])
    c = centroids.T[:, None, :]
    to_low, to_high = c - low[:, :, None], c - high[:, :, None]
    most = np.maximum(to_low ** 2, to_high ** 2)
    least = np.where((to_low >= 0) & (to_high <= 0), 0, np.minimum(to_low ** 2, to_high ** 2))
    return np.concatenate([least, most], axis=2)


def distances(vecs: np.ndarray, centroids: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Exact squared distances of vectors to the centroids marked in ``near``; to others the largest number."""
    out = np.full(near.shape, np.iinfo(np.int64).max)
    for i, c in enumerate(centroids):
        rows = np.flatnonzero(near[:, i])
        out[rows, i] = ((vecs[rows] - c) ** 2).sum(axis=1)
    return out


def _intervals(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    total = np.zeros((len(cells), tables.shape[2]), np.int64)
    for j, table in enumerate(tables):
        total += table[cells[:, j]]
    return total


def _fetch(path: str, rows: np.ndarray, size: int) -> np.ndarray:
    """Vectors of a block, by ascending row; rows next to each other are one read."""
    if not len(rows):
        return np.zeros((0, size), np.int64)
    cuts = np.flatnonzero(np.diff(rows) > 1) + 1
    runs = [(int(r[0]), len(r)) for r in np.split(rows, cuts)]
    spans = read_spans(path, [(4 * size * start, 4 * size * n) for start, n in runs])
    return np.concatenate([np.frombuffer(s, "<i4") for s in spans]).reshape(-1, size).astype(np.int64)


def _assign(path: str, cells: np.ndarray, tables: np.ndarray, centroids: np.ndarray):
    """(clusters, number of vectors that had to be fetched to know them)."""
    k, size = centroids.shape
    clusters, fetched = np.zeros(len(cells), np.int64), 0
    for at in range(0, len(cells), STEP):
        sums = _intervals(cells[at:at + STEP], tables)
        near = sums[:, :k] <= sums[:, k:].min(axis=1, keepdims=True)
        found = near.argmax(axis=1)
        open_rows = np.flatnonzero(near.sum(axis=1) > 1)
        if len(open_rows):
            vecs = _fetch(path, open_rows + at, size)
            found[open_rows] = distances(vecs, centroids, near[open_rows]).argmin(axis=1)
            fetched += len(open_rows)
        clusters[at:at + STEP] = found
    return clusters, fetched


def _round(blocks: DataFrame, bounds: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Blocks with their vectors' nearest clusters, and as ``delta`` what the vectors that
    moved add to and take from each cluster's sums and count."""
    k, size = centroids.shape

    def run(batches):
        tables = _tables(bounds, centroids)
        for batch in batches:
            for path, n, cells, clusters in zip(*[batch[c] for c in ("path", "n", "cells", "clusters")]):
                new, _ = _assign(path, np.frombuffer(cells, np.uint8).reshape(n, -1), tables, centroids)
                old, delta = np.frombuffer(clusters, "<u2").astype(np.int64), np.zeros((k, size + 1), np.int64)
                moved = np.flatnonzero(new != old)
                for at in range(0, len(moved), STEP):
                    rows = moved[at:at + STEP]
                    vecs = _fetch(path, rows, size)
                    for side, sign in ((new[rows], 1), (old[rows], -1)):
                        for c in np.unique(side[side != NONE]):
                            delta[c, :size] += sign * vecs[side == c].sum(axis=0)
                            delta[c, size] += sign * int((side == c).sum())
                yield {"path": [path], "n": [n], "cells": [cells],
                       "clusters": [new.astype("<u2").tobytes()], "delta": [delta.tobytes()]}

    return arrow_map(blocks, run, _BLOCKS)


def _summed(blocks: DataFrame, k: int, size: int) -> np.ndarray:
    """All blocks' deltas added up: one row per cluster and component reaches the driver."""
    def run(batches):
        total = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            for delta in batch["delta"]:
                total += np.frombuffer(delta, np.int64).reshape(k, size + 1)
        yield {"place": np.arange(total.size), "value": total.ravel()}

    out = np.zeros(k * (size + 1), np.int64)
    parts = arrow_map(blocks.select("delta"), run, "place long, value long")
    for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
        out[place] = value
    return out.reshape(k, size + 1)


def _measured(blocks: DataFrame, bounds: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    size = centroids.shape[1]

    def run(batches):
        tables = _tables(bounds, centroids)
        for batch in batches:
            for path, n, cells in zip(batch["path"], batch["n"], batch["cells"]):
                clusters, _ = _assign(path, np.frombuffer(cells, np.uint8).reshape(n, -1), tables, centroids)
                ids, named = read_spans(path, [(4 * size * n, 8 * n), ((4 * size + 8) * n, n)])
                ids, named = np.frombuffer(ids, "<i8").tolist(), np.frombuffer(named, np.uint8)
                for at in range(0, n, STEP):
                    end = min(n, at + STEP)
                    off = _fetch(path, np.arange(at, end), size) - centroids[clusters[at:end]]
                    yield {"vec_id": [x if y else None for x, y in zip(ids[at:end], named[at:end])],
                           "cluster": clusters[at:end], "distance": (off ** 2).sum(axis=1)}

    return arrow_map(blocks.select("path", "n", "cells"), run,
                     "vec_id long, cluster int, distance long")


def cluster(table: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: float = 256.0,
            salt: str = "2:") -> DataFrame:
    """One row per kept row of ``table`` (vec_id, embedding, any others): vec_id, cluster, distance
    (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``size`` components, none missing or infinite; every row
    counts, also with a repeated or missing vec_id (a missing one is named by the
    empty text). With fewer than ``k`` vectors each starts a cluster; no vector:
    no rows. Equally near centroids: the smaller number. Components over
    2**26 in size end the job, since distances would not fit.
    """
    if not 0 < k < NONE:
        raise ValueError(f"k must be between 1 and {NONE - 1}")
    spark = table.sparkSession
    vectors = whole_vectors(table, size, scale)
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT)
    bounds = cell_bounds(vectors, size)
    blocks = materialize(build(vectors, bounds), "blocks")
    sums = np.zeros((len(centroids), size + 1), np.int64)
    for i in range(rounds):
        after = materialize(_round(blocks, bounds, centroids), f"round-{i}")
        discard(blocks)
        blocks, sums = after, sums + _summed(after, len(centroids), size)
        some = sums[:, size] > 0
        centroids = centroids.copy()
        centroids[some] = sums[some, :size] // sums[some, size:]
    found = materialize(_measured(blocks, bounds, centroids), "clusters")
    discard(blocks)
    shas = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist())]
    names = spark.createDataFrame(shas, "cluster int, centroid_sha256 string")
    # One row per cluster, k at most: a broadcast of known size.
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.sum("distance").alias("inertia")).first()["inertia"]
    return (found.join(F.broadcast(each), "cluster").join(F.broadcast(names), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia",
                    F.lit(whole).cast("long").alias("inertia"), "centroid_sha256"))


_RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
           "centroid_sha256 string")


def oracle(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """DuckDB SQL with a pair of subqueries for each round."""
    ctes = [f"""
v AS (SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
      FROM embeddings
      WHERE len(embedding) = {size}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""", f"""
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q
       FROM (SELECT sha256('2:' || vec_id::VARCHAR) AS h, q FROM v ORDER BY h LIMIT {k}))"""]
    nearest = ("SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, c, list_sum(list_transform("
               f"range(1, {size + 1}), lambda i: (v.q[i] - x.q[i]) * (v.q[i] - x.q[i])))::BIGINT AS d "
               "FROM v, {0} x) GROUP BY r")
    for i in range(rounds):
        ctes.append(f"\na{i} AS MATERIALIZED ({nearest.format(f'c{i}')})")
        ctes.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT p.c, coalesce(n.q, p.q) AS q FROM c{i} p LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS q FROM (
      SELECT c, i, ((s - (s % n + n) % n) // n)::BIGINT AS m FROM (
        SELECT c, i, sum(q[i])::BIGINT AS s, count(*) AS n
        FROM v JOIN a{i} USING (r), range(1, {size + 1}) AS u(i) GROUP BY c, i)) GROUP BY c) n ON n.c = p.c)""")
    last = nearest.format(f"c{rounds}")
    return ("WITH" + ",".join(ctes) + f""",
a AS MATERIALIZED ({last})
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(x.q, ',')) AS centroid_sha256
FROM v JOIN a USING (r) JOIN c{rounds} x ON x.c = a.c
""")
