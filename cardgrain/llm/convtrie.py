"""Prefix trie of conversations, with subtree totals by depth-band rollup.

A node is a distinct sequence of first turns. It is named by a 128-bit digest
chained over its turns, which one pass over sorted slim rows computes (texts
are hashed where they are read and never shuffled). That pass also notes a
node's ancestors: those of its parent's *band* of ``HEIGHT`` depths and, for the
first depth of a band (a band root), those among the band roots of the next
coarser band, and so on. Subtree totals then need no walk along edges:

* up: within every band each node's values go to its ancestors of the band (at
  most ``HEIGHT``); band roots then hold their band's totals and do the same
  among themselves, in bands of bands;
* down: completed totals of band roots are added to the ancestors they hang from
  in the band above.

That makes 2 log(depth)/log(HEIGHT) + 1 aggregations, each of at most ``HEIGHT``
rows a node with partial sums, whatever the fan-out.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, discard, fold, materialize

HEIGHT = 8
CHUNK = 4096       # conversation ids packed into one row before they are hashed
HOT_SHARE = 1000   # parents with over a 1/1000 of all nodes as children are joined apart
KEY = 16
ROOT = bytes(KEY)


def slim_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): turns numbered by ``turn`` (missing first; turns with
    the same number in the order of their digests), with digest and word count."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text),
                       256)).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "key",
                        "words")


def share_openings(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Conversations as sequences of (conv_id, part, pos, key, words), in that order.

    Conversation c begins with the first h turns of conversation c - c % family
    (as many as there are), then has its own turns after its first h; h is
    crc32(c) % most. Each starts with a row of part 0 without a key, so that one
    without turns is there as well.
    """
    turns = materialize(turns, "turns")
    convs = turns.where("pos = 1").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("donor"),
        fold(F.col("conv_id"), most).alias("h"))
    opening = turns.where((F.col("pos") < most) & (F.col("conv_id") % family == 0)).select(
        F.col("conv_id").alias("donor"), "pos", "key", "words")
    start = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"),
                         F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("words"))
    lent = (convs.join(opening, "donor").where(F.col("pos") <= F.col("h"))
            .select("conv_id", F.lit(1).alias("part"), "pos", "key", "words"))
    own = (turns.where(F.col("pos") > fold(F.col("conv_id"), most))
           .select("conv_id", F.lit(2).alias("part"), "pos", "key", "words"))
    return start.unionByName(lent).unionByName(own)


def _walk(sequences: DataFrame, height: int) -> DataFrame:
    """A row per conversation and depth: the node with its parent and ancestors, the
    words of its last turn, and whether the conversation ends there.

    A conversation's rows pass one task in order, sorted by Spark (spilling where
    it must); the task holds a few digests, not the conversation.
    """
    def run(batches):
        conv, held, depth, node, stacks = None, None, 0, ROOT, []
        for batch in batches:
            out = []
            for c, key, words in zip(batch["conv_id"], batch["key"], batch["words"]):
                if held:
                    held["last"] = c != conv
                    out.append(held)
                if c != conv:
                    conv, depth, node, stacks = c, 0, ROOT, [[ROOT]]
                    held = {"node": ROOT, "parent": None, "depth": 0, "words": 0, "paths": []}
                else:
                    depth, parent = depth + 1, node
                    node = hashlib.sha256(parent + key).digest()[:KEY]
                    paths, level, rest = [b"".join(stacks[0])], 0, depth
                    while rest % height == 0:  # a band root: first of its band, last of nothing
                        stacks[level] = [node]
                        level, rest = level + 1, rest // height
                        if level == len(stacks):
                            stacks.append([ROOT])
                        paths.append(b"".join(stacks[level]))
                    stacks[level].append(node)
                    held = {"node": node, "parent": parent, "depth": depth, "words": words,
                            "paths": paths}
                held["conv_id"] = c
            if out:
                yield {k: [row[k] for row in out] for k in out[0]}
        if held:
            held["last"] = True
            yield {k: [v] for k, v in held.items()}

    ordered = sequences.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return arrow_map(ordered.select("conv_id", "key", "words"), run,
                     "node binary, parent binary, depth long, words long, paths array<binary>, "
                     "conv_id long, last boolean")


def _ancestors(path: Column) -> Column:
    last = (F.octet_length(path) / KEY).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.substring(path, i * KEY + 1, F.lit(KEY)))


def _sum(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("node").agg(*[F.sum(c).alias(c) for c in out.columns if c != "node"])


def _to_ancestors(frame: DataFrame, path: Column, children: Column) -> DataFrame:
    """Each row's leaves and saved for every ancestor of ``path``."""
    return frame.select(F.explode(_ancestors(path)).alias("node"), "leaves", "saved",
                        children.alias("children"))


def _subtrees(nodes: DataFrame, height: int) -> DataFrame:
    """(node, leaves, saved, children): totals over each node's subtree, and its children."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    top = 0
    while height ** (top + 1) <= deepest:
        top += 1
    level, none = F.size("paths") - 1, F.lit(0).cast("long")
    below = nodes.where("depth > 0")
    # Up: a node's path ends with its parent, which counts it as a child.
    path = F.col("paths")[0]
    inside = below.where(level == 0)
    sums = _sum(
        nodes.select("node", "leaves", "saved", none.alias("children")),
        _to_ancestors(inside, path, none),
        below.select(F.col("parent").alias("node"), none.alias("leaves"), none.alias("saved"),
                     F.lit(1).cast("long").alias("children")))
    totals = [materialize(sums, "band-0")]
    roots = nodes.where((level >= 1) | (F.col("depth") == 0)).select("node", "paths", "depth")
    for j in range(1, top + 1):
        at = roots.where((level >= j) | (F.col("depth") == 0)).join(
            totals[-1].drop("children"), "node").withColumn("children", none)
        up = at.where((level == j) & (F.col("depth") > 0))
        totals.append(materialize(_sum(at.select("node", "leaves", "saved", "children"),
                                       _to_ancestors(up, F.col("paths")[j], none)), f"band-{j}"))
    # Down: what hangs below a band is complete and goes to the band's ancestors.
    done = totals[-1]
    for j in range(top - 1, -1, -1):
        hanging = roots.where((level >= j + 1) & (F.col("depth") > 0)).join(
            done.select("node", "leaves", "saved"), "node")
        below_band = materialize(_sum(totals[j], _to_ancestors(hanging, F.col("paths")[j], none)),
                                 f"done-{j}")
        discard(done)
        discard(totals[j])
        done = below_band
    return done


def _ends(walk: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 over the sorted ids of the conversations that end at a node.

    Ids are sorted over all tasks and packed into rows of ``CHUNK``; a node that a
    third of all conversations end at then needs one pass over few rows, which
    hashes them in order and holds none.
    """
    def pack(batches):
        node, ids = None, []
        for batch in batches:
            out = {"node": [], "first": [], "ids": []}

            def put():
                for name, value in (("node", node), ("first", ids[0]), ("ids", ",".join(map(str, ids)))):
                    out[name].append(value)

            for n, c in zip(batch["node"], batch["conv_id"]):
                if ids and (n != node or len(ids) == CHUNK):
                    put()
                    ids = []
                node = n
                ids.append(c)
            yield out
        if ids:
            yield {"node": [node], "first": [ids[0]], "ids": [",".join(map(str, ids))]}

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = {"node": [], "ends_sha256": []}
            for n, ids in zip(batch["node"], batch["ids"]):
                if n == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out["node"].append(node)
                    out["ends_sha256"].append(state.hexdigest())
                node, state = n, hashlib.sha256(ids.encode())
            yield out
        if state:
            yield {"node": [node], "ends_sha256": [state.hexdigest()]}

    ends = walk.where("last").select("node", "conv_id")
    ends = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    packed = arrow_map(ends, pack, "node binary, first long, ids string")
    return arrow_map(packed.repartition("node").sortWithinPartitions("node", "first")
                     .select("node", "ids"), digest, "node binary, ends_sha256 string")


def trie(sequences: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the prefix trie of ``sequences`` (see :func:`share_openings`).

    conv_id (smallest member), depth, parent_conv_id (smallest member of the
    parent, missing for the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. No sequences: no rows.
    """
    walk = materialize(_walk(sequences, height), "walk")
    known = walk.groupBy("node", "parent", "depth", "words", "paths").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum(F.col("last").cast("long")).alias("n_ends"))
    nodes = materialize(known.withColumns({
        "leaves": (F.col("n_ends") == F.col("n_convs")).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words")}), "nodes")
    ends = _ends(walk)
    nothing = hashlib.sha256(b"").hexdigest()
    whole = materialize(
        nodes.select("node", "parent", "depth", "n_convs", "conv_id")
        .join(_subtrees(nodes, height), "node").join(ends, "node", "left")
        .select("node", "parent", "conv_id", "depth", "n_convs", F.col("children").alias("n_children"),
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")), "trie")
    discard(walk)
    discard(nodes)
    return _with_parents(whole)


def _with_parents(whole: DataFrame) -> DataFrame:
    """Adds the parents' conv_id. A parent of very many nodes would be one hot join
    key: those with over 1/``HOT_SHARE`` of all nodes as children (at most
    ``HOT_SHARE`` of them) are broadcast, the others are joined by a shuffle."""
    many = F.lit(max(100, whole.count() // HOT_SHARE))
    names = whole.where(F.col("n_children") > 0).select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(names.where(F.col("n_children") > many).drop("n_children"))
    met = whole.join(hot, "parent", "left")
    there = F.col("parent_conv_id").isNotNull() | F.col("parent").isNull()
    cold = names.where(F.col("n_children") <= many).drop("n_children")
    both = met.where(there).unionByName(met.where(~there).drop("parent_conv_id").join(cold, "parent"))
    return both.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                       "saved_tokens", "ends_sha256")


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """:func:`trie` of the rebuilt ``conversations`` (conv_id, turn, role, text, any others).

    A missing role or text counts as empty, a missing turn comes first; repeated
    rows are turns of their own. Rows without a conv_id belong to no conversation
    and are left out. An empty table gives no rows.
    """
    return trie(share_openings(slim_turns(conversations)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, key, words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos
  FROM (SELECT conv_id, turn,
               sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
             lambda a, x: list_reduce(list_prepend(xor(a, x), range(0, 8)),
               lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)),
             4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t)),
r AS (
  SELECT c.conv_id, 1 AS part, pos, key, words FROM c JOIN t ON t.conv_id = c.donor AND pos <= h
  UNION ALL
  SELECT c.conv_id, 2, pos, key, words FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
seq AS (
  SELECT c.conv_id, coalesce(k, []) AS k, coalesce(w, []) AS w
  FROM c LEFT JOIN (SELECT conv_id, list(key ORDER BY part, pos) AS k, list(words ORDER BY part, pos) AS w
                    FROM r GROUP BY conv_id) USING (conv_id)),
n AS (
  SELECT k[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sum(CASE WHEN len(k) = d THEN 1 ELSE 0 END) AS n_ends,
         coalesce(sha256(string_agg(CASE WHEN len(k) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id)),
                  sha256('')) AS ends_sha256,
         max(CASE WHEN d = 0 THEN 0 ELSE w[d] END) AS words
  FROM seq, unnest(range(0, len(k) + 1)) AS u(d) GROUP BY 1, 2),
sub AS (
  SELECT p[1:a] AS p, sum(CASE WHEN n_ends = n_convs THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * words) AS saved_tokens,
         sum(CASE WHEN a = depth - 1 THEN 1 ELSE 0 END) AS n_children
  FROM n, unnest(range(0, depth + 1)) AS u(a) GROUP BY 1)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sub ON sub.p = n.p LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]
"""
