"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ascending array of the k smallest distinct 48-bit hashes of a
text's word shingles. Two sketches merge by keeping the k smallest of both, so
the sketch of a collection is the merge of its parts; merged sketches estimate
distinct shingle counts, resemblance and containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm.common import ASCII_SPACE

K = 128
SHINGLE = 5
HASH_BITS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BLOCKS = 1 << 14  # bounds the block table that is broadcast
BLOCK_DOCS = 256


def sketch(text: Column, shingle: int = SHINGLE, k: int = K) -> Column:
    """The bottom-k sketch of a whole text (array<long>, ascending).

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer
    words than ``shingle`` make one shingle of the whole sequence; a null or
    empty text, or one without words, has the empty sketch.
    """
    word = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER),
                                  ASCII_SPACE), "")
    hashed = F.transform(word, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        n = F.size(h)
        whole = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.shiftrightunsigned(
            F.xxhash64(*[F.get(h, i + j) for j in range(shingle)]), 64 - HASH_BITS))
        short = F.array(F.shiftrightunsigned(F.xxhash64(h), 64 - HASH_BITS))
        return F.when(n >= shingle, whole).when(n > 0, short).otherwise(
            F.array().cast("array<long>"))

    # transform over a one-element array evaluates the word hashes once
    all_grams = F.get(F.transform(F.array(hashed), grams), 0)
    return F.slice(F.sort_array(F.array_distinct(all_grams)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k-1) over the
    k-th smallest hash as a share of the hash range."""
    top = F.element_at(s, F.lit(-1)).cast("double") + 1.0
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(
        F.lit(float(k - 1)) * F.lit(2.0 ** HASH_BITS) / top)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the merged sketch that is in
    both. Two empty sketches are alike (1), an empty one and another are not (0)."""
    both = F.array_intersect(a, b)
    out = F.transform(F.array(F.struct(merge(a, b, k).alias("m"), both.alias("b"))), lambda x: F.when(
        F.size(x["m"]) == 0, 1.0).otherwise(
            F.size(F.array_intersect(x["m"], x["b"])) / F.size(x["m"])))
    return F.get(out, 0)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's distinct shingles that b has too (1 for an empty a)."""
    union = distinct_count(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / F.greatest(distinct_count(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def text_form(s: Column) -> Column:
    """A sketch as a string: 12 hex digits a hash, base64."""
    hexed = F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 12, "0")), "")
    return F.base64(F.unhex(hexed))


def merged_sketches(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """(key, sketch): one sketch for every value of ``key``. A group of any size
    is spread by hash value, and only its k smallest hashes are gathered."""
    flat = sketches.select(F.col(key).alias("key"), F.explode(column).alias("h")).distinct()
    top = flat.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("h"))) \
        .where(F.col("r") <= k)
    return top.groupBy("key").agg(F.sort_array(F.collect_list("h")).alias("sketch")) \
        .withColumnRenamed("key", key)


def _block(bounds: list[int], doc_id: Column) -> Column:
    """Number of bounds at or below the id, by binary search in a literal array."""
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << s) for s in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda acc, step: F.when(
        (acc + step <= len(bounds)) & (F.get(table, acc + step - 1) <= doc_id),
        acc + step).otherwise(acc))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each document beside the next one in descending
    doc_id, the last beside the first.

    Rows are dealt by blocks of doc_id (bounds from quantiles, so any spread of
    ids gives even blocks); the first document of a block is also sent to the
    block before it as a guest, so a window over the block sees the next row of
    every document. Rows with the same doc_id follow each other by text. A row
    without doc_id is followed by the first document (by itself, if no row has
    an id) and follows none. A missing text is empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.where("doc_id is not null")
    n, first, nulls = rows.agg(F.count("doc_id"), F.max("doc_id"),
                               F.count_if(F.col("doc_id").isNull())).first()
    blocks = min(MAX_BLOCKS, max(1, n // BLOCK_DOCS))
    bounds = sorted(set(ids.agg(F.percentile_approx(
        "doc_id", [i / blocks for i in range(1, blocks)], 10 * MAX_BLOCKS)).first()[0] or [])) \
        if blocks > 1 else []
    dealt = ids.withColumn("block", _block(bounds, F.col("doc_id")) if bounds else F.lit(0))
    tops = (dealt.groupBy("block").agg(F.max("doc_id").alias("top"))
            .withColumnRenamed("block", "b"))
    # the first document of a block is the next one for the block above it (for
    # the highest block: the lowest one); at most MAX_BLOCKS rows
    above = F.lead("b").over(Window.orderBy("b"))
    tops = tops.select("top", F.coalesce(above, F.min("b").over(Window.partitionBy())).alias("to"))
    guests = F.when(F.col("to").isNotNull(), F.array(
        F.struct(F.lit(False).alias("guest"), F.col("block").alias("in")),
        F.struct(F.lit(True).alias("guest"), F.col("to").alias("in")))).otherwise(F.array(
            F.struct(F.lit(False).alias("guest"), F.col("block").alias("in"))))
    placed = dealt.join(F.broadcast(tops), F.col("doc_id") == F.col("top"), "left").select(
        "doc_id", "text", F.explode(guests).alias("g")).select("doc_id", "text", "g.guest", "g.in")
    order = Window.partitionBy("in").orderBy("guest", F.desc("doc_id"), "text")
    out = placed.withColumn("next_text", F.lead("text").over(order)).where("not guest") \
        .select("doc_id", "text", "next_text")
    if nulls:
        lone = rows.where("doc_id is null")
        if n:
            follower = ids.where(F.col("doc_id") == F.lit(first)).agg(F.min("text")).first()[0]
            lone = lone.withColumn("next_text", F.lit(follower))
        else:
            lone = lone.withColumn("next_text", F.col("text"))
        out = out.unionByName(lone)
    return out


def edited_fingerprints(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row of ``docs`` (null text: empty).

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document's, in the order of
    :func:`with_next`. near_edited and near_next: estimated resemblance of the
    text to its edited form and to the next document. One exchange of the
    texts; an empty table gives no rows; other columns are not read.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", "text", "next_text", n.cast("long").alias("n_chars"),
                       edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias(
        "edited_sha256"), sketch(F.col("text"), shingle, k).alias("s"),
        sketch(F.col("edited"), shingle, k).alias("e"),
        sketch(F.col("next_text"), shingle, k).alias("x"))
    return rows.select("doc_id", "n_chars", "edited_sha256",
                       text_form(F.col("s")).alias("fingerprint"),
                       text_form(F.col("e")).alias("edited_fingerprint"),
                       resemblance(F.col("s"), F.col("e"), k).alias("near_edited"),
                       resemblance(F.col("s"), F.col("x"), k).alias("near_next"))
