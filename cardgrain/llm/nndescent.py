"""Embedding near-dedup by NN-descent.

Equal vectors of a label are one node. Every node starts with the nearest
nodes it shares leaves of random-hyperplane trees with; then neighbour lists
are refined by joining neighbours of neighbours until few of them change. A list
that is full of links is saturated: there may be more, so it is enlarged to twice
its size, up to ``LARGEST``. Two nodes are linked where their cosine, in double
precision, is at least the threshold. A list holds only so many links and may miss
some among nodes known to be connected, so every component of three or more nodes
is counted whole: a small one in one block, a larger one by cells around some of
its nodes, where angles to a cell's centre tell which cells hold links only and
which hold none, and only the cells between are compared. Large leaves are cut by
planes between two of their members. An audit compares samples of
nodes, inside and outside those components, with all others; while too many of
them lack a link, new trees and refinements are added. If the passes run out,
all nodes of a label are compared, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, discard, materialize
from cardgrain.llm.graph import connected_components

LEAF = 64  # nodes a leaf has on average
GROUP = 256  # larger groups are cut into smaller ones
PLANES = 4  # planes that a large group is cut by at a time
SPLITS = 6  # times that planes cut; what is still large is cut by hash
BLOCK = 512  # nodes of a component compared in one block
CHUNK = 4096  # nodes of a larger component that meet its centres in one task
CENTRES = 1024  # most cells of a component
SLACK = 1e-6  # radians by which angles must be clear of the threshold
AUDIT = 2048  # nodes of an audit sample
EVIDENCE = 400  # audited nodes with a link that a verdict needs
PER_COMPONENT = 32  # nodes that the audit takes of a component compared whole
EXACT = 2048  # nodes of a block when all are compared
LARGEST = 64  # entries of an enlarged list; what such a list lacks, its component's blocks find
HOT_SHARE = 1000  # components of over 1/1000 of all nodes are joined apart


def _unit(vecs) -> np.ndarray:
    v = np.array(vecs, np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _sound(embedding):
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0)


def _rows(column: pa.Array):
    """A column as a function from a range of rows to a numpy array (vectors of one
    length: a matrix)."""
    if not pa.types.is_list(column.type):
        plain = column.to_numpy(zero_copy_only=False)
        return lambda start, end: plain[start:end]
    flat, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    at = at - at[0]
    return lambda start, end: flat[at[start]:at[end]].reshape(end - start, -1)


def _runs(batches, key: str):
    """(key, other columns as arrays) of each run of equal keys, across record batches."""
    now, parts = None, []

    def whole():
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}

    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).dictionary_encode()
        codes = keys.indices.to_numpy()
        columns = {c: _rows(b.column(c)) for c in b.schema.names if c != key}
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), b.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            value = keys.dictionary[int(codes[start])].as_py()
            if parts and value != now:
                yield now, whole()
                parts = []
            now = value
            parts.append({c: rows(start, end) for c, rows in columns.items()})
    if parts:
        yield now, whole()


def _grouped(rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over record batches in which the rows of a ``grp`` follow each other."""
    return arrow_map(rows.repartition("grp").sortWithinPartitions("grp"), run, schema, plain=False)


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest member index that each member of a group reaches."""
    label = np.arange(len(adjacent))
    while True:
        nxt = np.minimum(label, np.where(adjacent, label[None, :], len(label)).min(1))
        nxt = nxt[nxt]
        if (nxt == label).all():
            return label
        label = nxt


def _join_groups(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim): in every group of ``members`` (grp, nid, vec, k), each node's own ``k``
    nearest, and a link from each node to the root of those it is linked with
    (sim null: they are connected, not always linked)."""
    def run(batches):
        for _, g in _runs(batches, "grp"):
            ids, first = np.unique(g["nid"], return_index=True)
            if len(ids) < 2:
                continue
            v = _unit(g["vec"][first])
            s = v @ v.T
            np.fill_diagonal(s, -2)
            size = np.minimum(g["k"][first], len(ids) - 1)
            most = int(size.max())
            top = np.argpartition(-s, most - 1, axis=1)[:, :most]
            if size.min() < most:  # nearest first, so that each list ends at its own size
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
            rows = np.repeat(np.arange(len(ids)), most)
            cols = top.ravel()
            real = (s[rows, cols] > -1.5) & (np.tile(np.arange(most), len(ids)) < size[rows])
            rows, cols = rows[real], cols[real]
            yield {"a": ids[rows], "b": ids[cols], "sim": s[rows, cols]}
            near = s >= threshold
            if near.any():
                root = _roots(near)
                off = np.flatnonzero(root != np.arange(len(ids)))
                yield {"a": ids[off], "b": ids[root[off]], "sim": [None] * len(off)}

    return _grouped(members, run, "a long, b long, sim double")


def _large(rows: DataFrame) -> DataFrame:
    """(_grp, n): groups of over ``GROUP`` members."""
    return materialize(rows.groupBy(F.col("grp").alias("_grp")).agg(F.count("*").alias("n"))
                       .where(F.col("n") > GROUP), "large")


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, x: t + x)


def _cut(rows: DataFrame, turn: int) -> DataFrame:
    """``rows`` (grp, n, nid, vec, k) with groups cut by ``PLANES`` planes, each halfway
    between two members of the group that a hash picks: members near each other stay
    on the same side of most."""
    drawn = rows.where(F.pmod(F.xxhash64("nid", "grp", F.lit(turn)), F.ceil(F.col("n") / 64)) == 0)
    ends = drawn.groupBy(F.col("grp").alias("_grp")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.xxhash64("grp", "nid").alias("h"), "vec"))),
        lambda x: F.transform(x["vec"], lambda y: y / F.sqrt(_dot(x["vec"], x["vec"])))).alias("ends"))
    planes = ends.select("_grp", *[F.zip_with(
        F.get("ends", F.lit(2 * i)), F.get("ends", F.lit(2 * i + 1)), lambda x, y: x - y).alias(f"p{i}")
        for i in range(PLANES)])
    sides = [F.when(_dot(F.col("vec"), F.col(f"p{i}")) > 0, "1").otherwise("0") for i in range(PLANES)]
    return rows.join(planes, F.col("grp") == F.col("_grp"), "left").select(
        F.concat(F.col("grp"), F.lit("|"), *sides).alias("grp"), "nid", "vec", "k")


def _parted(members: DataFrame, key: list[str]) -> DataFrame:
    """``members`` with ``grp``: the key, and for large groups the side of planes between
    their members, again and again until few are large; those are cut by a hash."""
    rows = members.select(F.concat_ws("|", *key).alias("grp"), "nid", "vec", "k")
    large = _large(rows)
    done = None
    for turn in range(SPLITS + 1):
        if large.isEmpty():
            break
        small = rows.join(large, F.col("grp") == F.col("_grp"), "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, F.col("grp") == F.col("_grp")).drop("_grp")
        if turn == SPLITS:
            part = F.pmod(F.xxhash64("nid", "grp"), F.ceil(F.col("n") / GROUP))
            rows = rows.select(F.concat_ws("|", "grp", part).alias("grp"), "nid", "vec", "k")
            break
        rows = materialize(_cut(materialize(rows, "oversized"), turn), "cut")
        large = _large(rows)
    return rows if done is None else done.unionByName(rows)


def _leaves(nodes: DataFrame, trees: int, seed: int) -> DataFrame:
    """(label, dim, tree, code, nid, vec, k): each node's leaf in every tree."""
    def run(batches):
        planes = {}
        for b in batches:
            dims, bits, vectors = b["dim"].to_numpy(), b["bits"].to_numpy(), _rows(b["vec"])
            codes = np.zeros((b.num_rows, trees), np.int64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                v = _unit(np.concatenate([vectors(i, i + 1) for i in at]) if len(at) < len(dims)
                          else vectors(0, len(dims)))
                for t in range(trees):
                    if (d, t) not in planes:
                        planes[d, t] = np.random.default_rng([seed, d, t]).normal(size=(d, 32))
                    side = (v @ planes[d, t]) > 0
                    side &= np.arange(32)[None, :] < bits[at][:, None]
                    codes[at, t] = side @ (1 << np.arange(32, dtype=np.int64))
            yield {**{c: b[c] for c in b.schema.names if c != "bits"}, "codes": codes.tolist()}

    kind = nodes.schema["vec"].dataType.simpleString()
    coded = arrow_map(nodes.select("label", "dim", "bits", "nid", "vec", "k"), run,
                      f"label string, dim int, nid long, vec {kind}, k int, codes array<long>", plain=False)
    return coded.select("label", "dim", F.posexplode("codes").alias("tree", "code"), "nid", "vec", "k")


def _sized(nodes: DataFrame, sizes: DataFrame | None, k: int) -> DataFrame:
    """``nodes`` with the size of their lists: ``k``, or what a saturated one was enlarged to."""
    if sizes is None:
        return nodes.withColumn("k", F.lit(k))
    return nodes.join(sizes, nodes["nid"] == sizes["_of"], "left").withColumn(
        "k", F.coalesce("_size", F.lit(k))).drop("_of", "_size")


def _saturated(graph: DataFrame, sizes: DataFrame | None, k: int, threshold: float) -> DataFrame:
    """(_of, _size): the lists larger than ``k``, those that are full of links now doubled."""
    full = graph.groupBy(F.col("a").alias("nid")).agg(F.count("*").alias("n"), F.min("sim").alias("least"))
    full = _sized(full, sizes, k)
    more = F.when((F.col("n") >= F.col("k")) & (F.col("least") >= threshold),
                  F.least(2 * F.col("k"), F.lit(LARGEST))).otherwise(F.col("k"))
    return full.select(F.col("nid").alias("_of"), more.cast("int").alias("_size")).where(F.col("_size") > k)


def _best(edges: DataFrame, k: int, sizes: DataFrame | None = None) -> DataFrame:
    """Each node's nearest among ``edges``, seen from both ends, as many as its list holds."""
    both = edges.select("a", "b", "sim").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    one = both.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    one = one.withColumn("r", rank).where(F.col("r") <= LARGEST)
    return _sized(one.withColumnRenamed("a", "nid"), sizes, k).where(F.col("r") <= F.col("k")).select(
        F.col("nid").alias("a"), "b", "sim")


def _refined(nodes: DataFrame, graph: DataFrame, fresh: DataFrame, threshold: float) -> DataFrame:
    """Candidates from joining, at every node with a fresh list entry, its
    neighbours in both directions and itself."""
    both = graph.select("a", "b").unionByName(graph.select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    hubs = fresh.select(F.explode(F.array("a", "b")).alias("hub")).distinct()
    pairs = both.join(hubs, F.col("a") == F.col("hub"), "left_semi").select(
        F.col("a").alias("hub"), F.col("b").alias("nid"))
    members = pairs.join(nodes.select("nid", "vec", "k"), "nid").select(
        F.col("hub").cast("string").alias("hub"), "nid", "vec", "k")
    return _join_groups(_parted(members, ["hub"]), threshold)


def _changed(old: DataFrame, new: DataFrame) -> DataFrame:
    return new.join(old.select(F.col("a").alias("_a"), F.col("b").alias("_b")),
                    (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")


def _by_root(rows: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` (root, ...) joined with ``components`` (root, size, ...). All nodes of a large
    component share its root: components of over 1/``HOT_SHARE`` of the rows, which are
    ``HOT_SHARE`` at most, are broadcast; the others are joined by a shuffle."""
    large = F.col("size") > max(100, rows.count() // HOT_SHARE)
    hot = F.broadcast(components.where(large))
    rest = rows.join(F.broadcast(components.where(large).select("root")), "root", "left_anti")
    return rows.join(hot, "root").unionByName(rest.join(components.where(~large), "root"))


def _component_counts(nodes: DataFrame, roots: DataFrame, dense: DataFrame,
                      threshold: float) -> DataFrame:
    """(nid, links): links of the nodes of ``dense`` components, each counted in its
    whole component; copies count each."""
    def members(part):
        return _by_root(roots, part).join(nodes, F.col("node") == F.col("nid")).select(
            "root", "nid", "copies", "vec", "size")

    def run(batches):
        for _, g in _runs(batches, "grp"):
            v = _unit(g["vec"])
            near = v @ v.T >= threshold
            np.fill_diagonal(near, False)
            yield {"nid": g["nid"], "links": near @ g["copies"]}

    small = _grouped(members(dense.where(F.col("size") <= BLOCK)).select(
        F.col("root").cast("string").alias("grp"), "nid", "copies", "vec"), run, "nid long, links long")
    wide = dense.where(F.col("size") > BLOCK)
    if wide.isEmpty():
        return small
    return small.unionByName(_cell_counts(materialize(members(wide), "members"), threshold))


def _in_chunks(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Each chunk of a component's members (cell, of a centre: its own) with all its centres."""
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    mine = members.withColumn("chunk", F.pmod(F.xxhash64("nid", F.lit(1)), chunks).cast("int"))
    theirs = centres.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    columns = ["root", "size", "nid", "copies", "vec", "cell", "radius", "weight"]
    return mine.select(F.concat_ws("|", "root", "chunk").alias("grp"), *columns, F.lit(0).alias("centre")) \
        .unionByName(theirs.select(F.concat_ws("|", "root", "chunk").alias("grp"), *columns,
                                   F.lit(1).alias("centre")))


def _cell_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(nid, links) of the members (root, nid, copies, vec, size) of large components.

    Some members, about the root of the size, are centres; every member belongs to
    the cell of its nearest. A node's angle to a centre, with the cell's radius, shows
    by the triangle inequality that it is linked with the whole cell or with
    none of it; only other nodes are compared with the cell's members."""
    reach = float(np.arccos(threshold))
    bare = members.withColumn("cell", F.col("nid")).withColumn("radius", F.lit(0.0)).withColumn(
        "weight", F.lit(0).cast("long"))
    step = F.ceil(F.col("size") / F.least(F.lit(CENTRES), F.ceil(F.sqrt("size"))))
    centres = bare.where((F.col("nid") == F.col("root")) | (F.pmod(F.xxhash64("nid", F.lit(2)), step) == 0))
    kind = members.schema["vec"].dataType.simpleString()

    def angles(g):
        c, m = np.flatnonzero(g["centre"] == 1), np.flatnonzero(g["centre"] == 0)
        return m, c, np.arccos(np.clip(_unit(g["vec"][m]) @ _unit(g["vec"][c]).T, -1, 1))

    def assign(batches):
        for _, g in _runs(batches, "grp"):
            m, c, far = angles(g)
            best = far.argmin(1)
            yield {"root": g["root"][m], "size": g["size"][m], "nid": g["nid"][m],
                   "copies": g["copies"][m], "vec": list(g["vec"][m]), "cell": g["nid"][c[best]],
                   "radius": far[np.arange(len(m)), best]}

    assigned = materialize(_grouped(_in_chunks(bare, centres), assign,
                                    f"root long, size long, nid long, copies long, vec {kind}, "
                                    "cell long, radius double"), "cells")
    cells = materialize(assigned.groupBy(F.col("cell").alias("_cell")).agg(
        F.max("radius").alias("radius"), F.sum("copies").alias("weight"), F.count("*").alias("n")), "radii")
    used = centres.drop("radius", "weight").join(cells.drop("n"), F.col("cell") == F.col("_cell")).drop("_cell")

    def decide(batches):
        for _, g in _runs(batches, "grp"):
            m, c, far = angles(g)
            radius, weight = g["radius"][c][None, :], g["weight"][c]
            every = far + radius < reach - SLACK
            some = ~every & (far - radius <= reach + SLACK)
            own = every & (g["cell"][m][:, None] == g["nid"][c][None, :])
            yield {"nid": g["nid"][m], "links": every @ weight - own.any(1) * g["copies"][m],
                   "cell": [None] * len(m)}
            at, to = np.nonzero(some)
            yield {"nid": g["nid"][m[at]], "links": np.zeros(len(at), np.int64), "cell": g["nid"][c[to]]}

    decided = materialize(_grouped(_in_chunks(assigned.withColumn("weight", F.lit(0).cast("long")), used),
                                   decide, "nid long, links long, cell long"), "decided")
    sure = decided.where("cell is null").select("nid", "links")
    visits = decided.where("cell is not null").select("nid", F.col("cell").alias("to"))
    shape = visits.groupBy(F.col("to").alias("_to")).agg(F.count("*").alias("visitors")).join(
        cells, F.col("_to") == F.col("_cell")).select(
        "_to", F.ceil(F.col("visitors") / EXACT).cast("int").alias("vb"),
        F.ceil(F.col("n") / EXACT).cast("int").alias("mb"))
    shape = materialize(shape, "shape")

    def block(count):
        return F.pmod(F.xxhash64("nid", F.lit(3)), F.col(count)).cast("int")

    def meeting(other):
        return F.explode(F.sequence(F.lit(0), F.col(other) - 1))

    mine = visits.join(shape, F.col("to") == F.col("_to")).select("to", "nid", block("vb").alias("v"), meeting("mb").alias("m")) \
        .join(assigned.select(F.col("nid").alias("_nid"), "copies", "vec"), F.col("nid") == F.col("_nid")).drop("_nid") \
        .withColumn("side", F.lit(0))
    theirs = assigned.join(shape, F.col("cell") == F.col("_to")).select(
        F.col("cell").alias("to"), "nid", meeting("vb").alias("v"), block("mb").alias("m"), "copies", "vec",
        F.lit(1).alias("side"))

    def compare(batches):
        for _, g in _runs(batches, "grp"):
            v, ids = _unit(g["vec"]), g["nid"]
            m, o = np.flatnonzero(g["side"] == 0), np.flatnonzero(g["side"] == 1)
            linked = (v[m] @ v[o].T >= threshold) & (ids[m][:, None] != ids[o][None, :])
            yield {"nid": ids[m], "links": linked @ g["copies"][o]}

    compared = _grouped(mine.unionByName(theirs).select(
        F.concat_ws("|", "to", "v", "m").alias("grp"), "nid", "copies", "vec", "side"),
        compare, "nid long, links long")
    return sure.unionByName(compared).groupBy("nid").agg(F.sum("links").alias("links"))


def _audit(nodes: DataFrame, sample: DataFrame, threshold: float) -> DataFrame:
    """(nid, truth): for each sampled node the links it has among all nodes."""
    got = sample.collect()  # a few times AUDIT rows
    by: dict[tuple, tuple] = {}
    for key in {(r["label"], r["dim"]) for r in got}:
        rows = [r for r in got if (r["label"], r["dim"]) == key]
        by[key] = ([r["nid"] for r in rows], _unit([r["vec"] for r in rows]))

    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            keys = list(zip(b["label"].to_pylist(), b["dim"].to_pylist()))
            vectors, nid, copies = _rows(b["vec"]), b["nid"].to_numpy(), b["copies"].to_numpy()
            for key in set(keys) & set(by):
                at = [i for i, x in enumerate(keys) if x == key]
                ids, v = by[key]
                near = (v @ _unit(np.concatenate([vectors(i, i + 1) for i in at])).T) >= threshold
                near &= np.array(ids)[:, None] != nid[at][None, :]
                counts = near @ copies[at]
                for q, n in zip(ids, counts.tolist()):
                    total[q] = total.get(q, 0) + n
        yield {"nid": list(total), "truth": list(total.values())}

    return arrow_map(nodes.select("label", "dim", "nid", "copies", "vec"), run,
                     "nid long, truth long", plain=False).groupBy("nid").agg(F.sum("truth").alias("truth"))


def _recalled(nodes: DataFrame, counted: DataFrame, roots: DataFrame, dense: DataFrame,
              threshold: float, target: float, turn: int) -> bool:
    """Whether ``target`` of the nodes that have links have all of them: once among
    the nodes outside the components compared whole, once among a few nodes of each
    such component. Samples are added until ``EVIDENCE`` nodes with links were seen
    or every node was compared, so rare links are no proof of none."""
    inside = roots.join(dense, "root").select(F.col("node").alias("nid"), "size")
    every = materialize(nodes.select("nid").join(inside, "nid", "left"), "strata")
    few = F.pmod(F.xxhash64("nid", F.lit(turn)), F.col("size")) < PER_COMPONENT
    for part in (every.where("size is null"), every.where(few)):
        samples = -(-part.count() // AUDIT)
        bucket = F.pmod(F.xxhash64(F.lit(turn), "nid"), F.lit(max(1, samples)))
        seen = whole = at = 0
        take = 1
        while at < samples and seen < EVIDENCE:
            drawn = part.where((bucket >= at) & (bucket < at + take)).select("nid")
            truth = _audit(nodes, nodes.join(drawn, "nid"), threshold).where("truth > 0")
            all_found = F.coalesce("links", F.lit(0)) >= F.col("truth")
            n, found = truth.join(counted, "nid", "left").agg(
                F.count("*"), F.sum(all_found.cast("long"))).first()
            seen, whole, at, take = seen + n, whole + (found or 0), at + take, min(2 * take, 4)
        if whole < target * seen:
            return False
    return True


def _all_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    """(nid, other, links): all nodes of a label and length compared, in blocks. A
    row for each node that has links in a pair of blocks: their number (copies
    count each) and a node connected with it."""
    sizes = nodes.groupBy("label", "dim").count().select(
        F.col("label").alias("_label"), F.col("dim").alias("_dim"),
        F.ceil(F.col("count") / EXACT).cast("int").alias("blocks"))
    rows = nodes.join(sizes, (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))) \
        .withColumn("block", F.pmod(F.xxhash64("nid"), "blocks").cast("int"))
    # a block meets itself (side 0), the later blocks (1) and the earlier ones (2)
    met = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = met.select(
        F.concat_ws("|", "label", "dim", F.least("block", "met"), F.greatest("block", "met")).alias("grp"),
        "nid", "copies", "vec",
        F.when(F.col("met") == F.col("block"), 0).when(F.col("met") > F.col("block"), 1)
        .otherwise(2).alias("side"))

    def run(batches):
        for _, g in _runs(batches, "grp"):
            side, v, ids, weight = g["side"], _unit(g["vec"]), g["nid"], g["copies"]
            m, o = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
            linked = (v[m] @ v[o].T >= threshold) & (ids[m][:, None] != ids[o][None, :])
            rows, cols = linked.any(1), linked.any(0)
            m, o, linked = m[rows], o[cols], linked[rows][:, cols]
            if not len(m):
                continue
            mine, theirs = _bipartite_roots(linked)
            yield {"nid": ids[m], "other": ids[m[mine]], "links": linked @ weight[o]}
            both = weight[m] @ linked if side.any() else np.zeros(len(o), np.int64)
            yield {"nid": ids[o], "other": ids[m[theirs]], "links": both}

    return _grouped(members, run, "nid long, other long, links long")


def _bipartite_roots(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each column of a table of links (each has one), the
    smallest row that it reaches."""
    mine, none = np.arange(len(linked), dtype=np.int32), np.int32(len(linked))
    while True:
        theirs = np.where(linked, mine[:, None], none).min(0)
        nxt = np.where(linked, theirs[None, :], none).min(1)
        nxt = nxt[nxt]
        if (nxt == mine).all():
            return mine, theirs
        mine = nxt


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, k: int = 8, trees: int = 8,
                    rounds: int = 2, target: float = 0.98, max_passes: int = 6) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding, label).

    Vectors are compared only when labels are equal and not null (and lengths
    are equal). Null, zero, or non-finite vectors link with nothing and are
    their own component. Copies of a vector link with each other; repeated
    rows of one vec_id are one vector. A row without vec_id links with
    nothing and has no component; an empty table gives no rows; other columns
    are not read. ``component_id`` is the smallest vec_id reachable, ``kept``
    marks the row that has it. Passes end when the audit finds all links of
    ``target`` of the nodes that have any; after ``max_passes`` without that,
    all nodes are compared.
    """
    # single-precision components travel as they are; every task compares in double precision
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast(kind).alias("vec"),
                          F.col("label").cast("string").alias("label"))
    usable = _sound(F.col("vec")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = materialize(rows.select(
        "vec_id", F.when(usable, F.xxhash64("label", "vec")).alias("nid"),
        F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("vec")).alias("vec")),
        "rows")
    sound = rows.where("nid is not null").distinct()
    nodes = sound.groupBy("nid", "label", "vec").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("low")) \
        .withColumn("dim", F.size("vec"))
    nodes = materialize(nodes, "nodes")
    sizes = nodes.groupBy("label", "dim").count().select(
        F.col("label").alias("_label"), F.col("dim").alias("_dim"), F.greatest(
            F.lit(0), F.ceil(F.log2(F.col("count") / LEAF))).cast("int").alias("bits"))
    nodes = materialize(nodes.join(sizes, (F.col("label") == F.col("_label")) & (
        F.col("dim") == F.col("_dim"))).drop("_label", "_dim"), "nodes")

    graph = links = joined = counted = sizes = None
    for turn in range(max_passes):
        found = materialize(_join_groups(_parted(
            _leaves(_sized(nodes, sizes, k), trees, turn), ["label", "dim", "tree", "code"]),
            threshold), "found")
        for step in range(rounds + 1):
            lists = found.where("sim is not null")
            news = [x for x in (links, lists.where(F.col("sim") >= threshold)) if x is not None]
            wide = news[0] if len(news) == 1 else news[0].unionByName(news[1])
            nxt_links = materialize(_best_links(wide), "links")
            near = found.where("sim is null").select("a", "b").distinct()
            joined = materialize(near if joined is None else joined.unionByName(near).distinct(),
                                 "joined")
            nxt = materialize(_best(lists if graph is None else graph.unionByName(lists), k, sizes), "graph")
            fresh = nxt if graph is None else materialize(_changed(graph, nxt), "fresh")
            graph, links = nxt, nxt_links
            sizes = materialize(_saturated(graph, sizes, k, threshold), "sizes")
            if step == rounds or fresh.count() < 0.05 * graph.count():
                break
            nxt_found = materialize(_refined(_sized(nodes, sizes, k), graph, fresh, threshold), "found")
            discard(found)
            found = nxt_found
        roots = materialize(connected_components(
            links.select("a", "b").unionByName(joined), "a", "b"), "roots")
        counts, dense = _counts(nodes, links, roots, threshold)
        counted = materialize(counts, "counts")
        if _recalled(nodes, counted, roots, dense, threshold, target, turn):
            break
    else:
        whole = materialize(_all_pairs(nodes, threshold), "whole")
        roots = materialize(connected_components(whole, "nid", "other"), "roots")
        counted = materialize(whole.groupBy("nid").agg(F.sum("links").alias("links")), "counts")

    linked = nodes.select("nid", "copies", "low").join(counted, "nid", "left").join(
        roots.withColumnRenamed("node", "nid"), "nid", "left").select(
        "nid", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "nid").alias("root"))
    linked = materialize(linked, "linked")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("size"))
    result = materialize(_by_root(linked, lows).select(
        F.col("nid").alias("r_nid"), "n_links", "component_id"), "result")
    out = rows.select("vec_id", "nid").join(result, F.col("nid") == F.col("r_nid"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _best_links(edges: DataFrame) -> DataFrame:
    """Links once each, smaller node first."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim") \
        .groupBy("a", "b").agg(F.max("sim").alias("sim"))


def _counts(nodes: DataFrame, links: DataFrame, roots: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(nid, links): from the lists, or, in components of three or more nodes, from
    the whole component; and those components (root, size)."""
    ends = links.select("a", "b").unionByName(links.select(
        F.col("b").alias("a"), F.col("a").alias("b")))
    dense = materialize(roots.groupBy("root").agg(F.count("*").alias("size")).where("size > 2"), "dense")
    sparse = ends.join(roots.select("node", "root"), F.col("a") == F.col("node")).join(
        dense.select("root"), "root", "left_anti")
    few = sparse.select("a", "b").join(nodes.select(F.col("nid").alias("n"), "copies"),
                                       F.col("b") == F.col("n")) \
        .groupBy(F.col("a").alias("nid")).agg(F.sum("copies").alias("links"))
    return few.unionByName(_component_counts(nodes, roots, dense, threshold)), dense
