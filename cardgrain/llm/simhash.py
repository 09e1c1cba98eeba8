"""SimHash near-dedup with pigeonring candidate filtering.

The 64 bits are cut into ``segments`` equal segments placed on a ring. If two
fingerprints differ in at most ``max_bits`` bits, then from some segment on
every chain of the next ``l`` segments differs in at most
``l * max_bits / segments`` bits (the pigeonring principle). Candidates must
hold that for every ``l``; only then are all 64 bits compared.

The chain gives the join key: its longest prefix with a budget of 0 must be
equal, and of the next segments, up to a budget of 1, all but one must be
equal. With 8 segments and 3 bits that is 32 equal bits under 24 keys per
fingerprint, so random matches stay rare at any size that fits 64-bit prints.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, materialize, without, words
from cardgrain.llm.graph import connected_components

BITS = 64
BLOCK = 1 << 16  # shingles whose bits are counted at once
HOT_BUCKET = 8192  # from here masks (4960 a member) cost less than pairs


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included.

    A bit is set if it is set in over half of the shingles' XXH64 (seed 42).
    Fewer words than ``shingle``: the whole sequence is one shingle; no word
    (also null or empty text): 0.
    """
    w = words(text)
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        part = w[at:min(at + BLOCK, n) + shingle - 1]
        grams = (map(b" ".join, zip(*(part[k:] for k in range(shingle))))
                 if len(w) >= shingle else iter([b" ".join(w)]))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the SimHash of every whole text, as a signed long."""
    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "fp": [fingerprint(t, shingle) for t in b["text"]]}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, fp long")


def _budgets(max_bits: int, segments: int) -> list[int]:
    return [ln * max_bits // segments for ln in range(segments + 1)]


def _key_layout(max_bits: int, segments: int) -> list[tuple[int, list[int]]]:
    """(start, equal segments) of every join key."""
    budget = _budgets(max_bits, segments)
    zero = max(ln for ln, b in enumerate(budget) if b == 0)
    if zero == 0:
        raise ValueError("segments must exceed max_bits")
    one = max(ln for ln, b in enumerate(budget) if b <= 1)
    keys = []
    for start in range(segments):
        ring = [(start + j) % segments for j in range(one)]
        if one == zero:
            keys.append((start, ring))
        else:
            keys += [(start, ring[:zero] + [s for j, s in enumerate(ring[zero:]) if j != skip])
                     for skip in range(one - zero)]
    return keys


def _segment(fp: Column, s: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, s * width).bitwiseAND(F.lit((1 << width) - 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_pairs(prints: DataFrame, max_bits: int = 3, segments: int = 8,
               hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(a, b): links that give the components of ``prints`` (distinct fp).

    Every pair of fingerprints within ``max_bits`` bits is a row, but for
    buckets with over ``hot_bucket`` members: there every member is linked,
    for each choice of ``max_bits`` of the bits its key leaves free, to the
    smallest member that agrees on all other bits. That links exactly the
    same components in linear work.
    """
    if BITS % segments:
        raise ValueError("segments must divide 64")
    width = BITS // segments
    layout = _key_layout(max_bits, segments)
    fp = F.col("fp")
    keys = []
    for start, equal in layout:
        mix = F.lit(0).cast("long")
        for s in equal:
            mix = F.shiftleft(mix, width).bitwiseOR(_segment(fp, s, width))
        keys.append(mix)
    keyed = prints.select("fp", F.posexplode(F.array(*keys)).alias("k", "key"))
    keyed = materialize(keyed, "keys")
    hot = materialize(keyed.groupBy("k", "key").count().where(F.col("count") > hot_bucket)
                      .select("k", "key"), "hot")
    left, right = keyed, keyed
    hot_rows = None
    if not hot.isEmpty():
        hot_rows = keyed.join(hot, ["k", "key"], "left_semi")
        left = keyed.join(hot, ["k", "key"], "left_anti")
        right = left
    left = left.select("k", "key", F.col("fp").alias("a"))
    right = right.select(F.col("k").alias("k2"), F.col("key").alias("key2"),
                         F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    turn = f"element_at(array({','.join(str(s * width) for s, _ in layout)}), k + 1)"
    ring = F.expr(f"shiftrightunsigned(a ^ b, {turn}) | shiftleft(a ^ b, 64 - {turn})")
    chain = F.bit_count(x) <= max_bits
    for ln, budget in enumerate(_budgets(max_bits, segments)):
        if 0 < ln < segments:
            mask = _signed((1 << (ln * width)) - 1)
            chain = chain & (F.bit_count(ring.bitwiseAND(F.lit(mask).cast("long"))) <= budget)
    pairs = left.join(right, (F.col("k") == F.col("k2")) & (F.col("key") == F.col("key2"))
                      & (F.col("a") < F.col("b")) & chain).select("a", "b")
    if hot_rows is not None:
        pairs = pairs.unionByName(_masked_links(hot_rows, layout, max_bits, width))
    return pairs.distinct()


def _masked_links(hot_rows: DataFrame, layout: list, max_bits: int, width: int) -> DataFrame:
    """Star links inside large buckets, one for each mask over the free bits."""
    # keys x C(free bits, max_bits) rows, whatever the data: a fixed, small table
    rows = [(k, _signed(sum(1 << b for b in c))) for k, (_, equal) in enumerate(layout)
            for c in combinations([b for b in range(BITS) if b // width not in equal], max_bits)]
    table = hot_rows.sparkSession.createDataFrame(rows, "k int, mask long")
    wide = hot_rows.join(F.broadcast(table), "k")
    group = ["k", "key", "mask", "rest"]
    wide = wide.withColumn("rest", F.col("fp").bitwiseAND(F.bitwise_not("mask")))
    low = wide.groupBy(*group).agg(F.min("fp").alias("a"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    return (wide.join(low, group).where("fp <> a")
            .select("a", F.col("fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    segments: int = 8, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Texts are compared whole; equal fingerprints are one node, so copies are
    never expanded into pairs. ``fingerprint``: 16 lowercase hex digits.
    ``component_id``: smallest doc_id linked directly or through others, the
    row itself included. Null or empty texts have fingerprint zero and are
    linked like any other; rows without doc_id keep their place (they get the
    smallest doc_id of their component, null if it has none). Repeated rows
    give repeated rows; an empty table gives an empty table; other columns of
    ``docs`` are not read.
    """
    prints = materialize(fingerprints(docs, shingle), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(near_pairs(nodes.select("fp"), max_bits, segments, hot_bucket),
                                 "a", "b").withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = materialize(rooted.join(lows, "root").select(
        F.col("fp").alias("fp2"), "component_id"), "components")
    return prints.join(by_print, F.col("fp") == F.col("fp2")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the
    smallest doc_id (every row without a doc_id stays; of rows that repeat
    that doc_id one stays). Columns as in ``docs``.
    """
    parts = materialize(near_duplicates(docs, **params), "parts").where("doc_id is not null")
    gone = parts.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = without(docs, gone)
    again = materialize(parts.groupBy("doc_id").count().where("count > 1")
                        .select(F.col("doc_id").alias("_gone")), "again")
    if again.isEmpty():
        return kept
    repeated = kept.join(again, F.col("doc_id") == F.col("_gone"), "left_semi")
    return without(kept, again).unionByName(repeated.dropDuplicates(["doc_id"]))
