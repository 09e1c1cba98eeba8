"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every *sender* (a run of ``SENDER_ROWS`` rows of one input file) hashes its
   texts into a universe of about 2**12 places per document, sorts the distinct
   fingerprints and sends each *owner* of a range of the universe its slice,
   Golomb-coded (about 14 bits and less a fingerprint).
2. An owner decodes the slices of its range and answers each with a bitmap: one
   bit per fingerprint, set if another slice holds it too.
3. A sender reads its bitmaps against its own list. Only rows whose fingerprint
   is marked, or repeats within the sender, are *suspects*: their texts alone are
   shuffled, grouped by their bytes. All other rows are known to be unique.

The texts are read twice and never copied. A copied text crosses the network
once per task that holds it (partial counts), however often it occurs, and its
rows learn their group through one row per sender and text, so a group of a
third of all rows is spread over all senders.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm import golomb
from cardgrain.llm.common import arrow_map, discard, materialize, shared_path
from cardgrain.llm.files import publish_file, read_file

SENDER_ROWS = 1 << 20
OWNER_ROWS = 1 << 20   # fingerprints an owner gets, about
SPARE_BITS = 12        # a text meets a stranger's fingerprint once in 2**12 times
SENDER, ROW = "__sender", "__row"


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with its sender and its row number there.

    Rows read from files are known by file and position, the same in every run.
    Anything else is written into the shared folder first. (Cut files by
    filters only: ``limit`` or ``sample`` may pick other rows in a second run.)
    """
    def place(d: DataFrame) -> DataFrame:
        meta = d.metadataColumn("_metadata")
        return d.select("*", F.concat(meta["file_path"], F.lit("#"), F.floor(
            meta["row_index"] / SENDER_ROWS).cast("string")).alias(SENDER),
            meta["row_index"].alias(ROW))

    try:
        return place(docs)
    except AnalysisException:
        return place(materialize(docs, "rows"))


def _lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased, a missing one as the empty text."""
    return pc.fill_null(pc.ascii_lower(texts), "")


def _fingerprints(texts: pa.Array, bits: int) -> np.ndarray:
    found = [xxhash.xxh3_64_intdigest(t) for t in texts.cast(pa.binary()).to_pylist()]
    return np.array(found, np.uint64) >> np.uint64(64 - bits)


def _runs(names: list[str]):
    """(start, end) of the runs of equal names."""
    start = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[start]:
            yield start, i
            start = i


def _send(rows: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """A row per sender, part (the rows that one task read of it) and owner: the
    coded slice, and a bitmap of what repeats within the part."""
    shift = bits - owner_bits

    def slices(sender, part, chunks):
        prints, times = np.unique(np.concatenate(chunks), return_counts=True)
        owners = (prints >> np.uint64(shift)).astype(np.int64)
        for start, end in _runs(owners):
            owner = int(owners[start])
            yield {"sender": sender, "part": part, "owner": owner,
                   "codes": golomb.encode(prints[start:end], owner << shift),
                   "local": np.packbits(times[start:end] > 1).tobytes()}

    def run(batches):
        sender = part = None
        chunks: list[np.ndarray] = []
        for batch in batches:
            names, first = batch.column(0).to_pylist(), batch.column(1)
            prints = _fingerprints(_lowered(batch.column(2)), bits)
            out = []
            for start, end in _runs(names):
                if names[start] != sender:
                    out += slices(sender, part, chunks) if chunks else []
                    sender, part, chunks = names[start], first[start].as_py(), []
                chunks.append(prints[start:end])
            if out:
                yield _columns(out)
        if chunks:
            yield _columns(list(slices(sender, part, chunks)))

    return arrow_map(rows.select(SENDER, ROW, "text"), run,
                     "sender string, part long, owner long, codes binary, local binary", plain=False)


def _columns(rows: list[dict]) -> dict[str, list]:
    return {k: [r[k] for r in rows] for k in rows[0]}


def _answer(sent: DataFrame, shift: int) -> DataFrame:
    """Owners' bitmaps: which fingerprints of a slice another slice holds too."""
    def run(table: pa.Table) -> pa.Table:
        base = table.column("owner")[0].as_py() << shift
        lists = [golomb.decode(c, base) for c in table.column("codes").to_pylist()]
        whole = np.concatenate(lists)
        _, at, times = np.unique(whole, return_inverse=True, return_counts=True)
        shared, ends = times[at] > 1, np.cumsum([len(x) for x in lists])
        marks = [np.packbits(x).tobytes() for x in np.split(shared, ends[:-1])]
        return table.select(["sender", "part", "owner"]).append_column(
            "marks", pa.array(marks, pa.binary()))

    return (sent.select("sender", "part", "owner", "codes").groupBy("owner")
            .applyInArrow(run, "sender string, part long, owner long, marks binary"))


def _file_of(root: str, sender: str) -> str:
    return f"{root}/{hashlib.sha1(sender.encode()).hexdigest()}"


def _receive(sent: DataFrame, marks: DataFrame, shift: int, root: str) -> DataFrame:
    """Writes each sender's suspect fingerprints (at most ``SENDER_ROWS``), sorted,
    into a file of the shared folder; returns (sender, how many)."""
    def run(table: pa.Table) -> pa.Table:
        sender, found = table.column("sender")[0].as_py(), []
        for row in table.select(["owner", "codes", "local", "marks"]).to_pylist():
            prints = golomb.decode(row["codes"], row["owner"] << shift)
            bits = np.unpackbits(np.frombuffer(row["local"], np.uint8)
                                 | np.frombuffer(row["marks"], np.uint8), count=len(prints))
            found.append(prints[bits.astype(bool)])
        whole = np.unique(np.concatenate(found))
        publish_file(_file_of(root, sender), whole.tobytes())
        return pa.table({"sender": [sender], "n": pa.array([len(whole)], pa.int64())})

    return (sent.join(marks, ["sender", "part", "owner"]).groupBy("sender")
            .applyInArrow(run, "sender string, n long"))


def _flagged(rows: DataFrame, bits: int, root: str) -> DataFrame:
    """(doc_id, sender, row, sha, text): the lower-cased text for suspects only."""
    def run(batches):
        known: OrderedDict[str, np.ndarray] = OrderedDict()

        def suspects(sender: str) -> np.ndarray:
            if sender not in known:
                known[sender] = np.frombuffer(read_file(_file_of(root, sender)), np.uint64)
                while len(known) > 2:
                    known.popitem(last=False)
            return known[sender]

        for batch in batches:
            names, texts = batch.column(1).to_pylist(), _lowered(batch.column(3))
            prints = _fingerprints(texts, bits)
            hit = np.zeros(len(names), bool)
            for start, end in _runs(names):
                hit[start:end] = np.isin(prints[start:end], suspects(names[start]))
            sha = [hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()]
            shown = pc.if_else(pa.array(hit), texts, pa.scalar(None, texts.type))
            yield {"doc_id": batch.column(0), "sender": batch.column(1), "row": batch.column(2),
                   "sha": sha, "text": shown.cast(pa.string())}

    return arrow_map(rows.select("doc_id", SENDER, ROW, "text"), run,
                     "doc_id long, sender string, row long, sha string, text string", plain=False)


def _suspects(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The flagged rows, and the tables that may go when they are no longer read."""
    spark = rows.sparkSession
    n = rows.count()
    owner_bits = max(3, (n // OWNER_ROWS).bit_length())
    bits = min(63, max(owner_bits + 1, n.bit_length() + SPARE_BITS))
    shift, root = bits - owner_bits, shared_path(spark, "suspects")
    sent = materialize(_send(rows, bits, owner_bits), "slices")
    # The answers are few bytes; they are written so that a retried receiver reads them again.
    marks = materialize(_answer(sent, shift), "marks")
    _receive(sent, marks, shift, root).agg(F.sum("n")).collect()
    return materialize(_flagged(rows, bits, root), "flagged"), [sent, marks]


def _grouped(rows: DataFrame) -> DataFrame:
    """(sender, row, doc_id, keep_id, group_size, kept, text_sha256) of every located row."""
    flagged, spent = _suspects(rows)
    for table in spent:
        discard(table)
    alone = flagged.where(F.col("text").isNull()).select(
        "sender", "row", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias(
            "group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    # Byte verification: the texts themselves are the grouping key.
    texts = (flagged.where(F.col("text").isNotNull()).groupBy("sha", "text")
             .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
             .groupBy("sha").agg(F.count("*").alias("texts"), F.max("group_size").alias("group_size"),
                                 F.max("keep_id").alias("keep_id")))
    one = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error("two texts with the same SHA-256 are not equal").cast("long"))
    texts = texts.select("sha", one.alias("group_size"), "keep_id")
    slim = flagged.where(F.col("text").isNotNull()).select("sender", "row", "doc_id", "sha")
    # One row per sender and text: its largest doc_id, the first row that has it.
    top = F.max(F.struct("doc_id", (-F.col("row")).alias("back")))
    same = Window.partitionBy("sha")
    best = F.max(F.struct("top.doc_id", "top.back", "sender")).over(same)
    shares = (slim.groupBy("sender", "sha").agg(top.alias("top")).join(texts, "sha")
              .withColumn("best", best)
              .select("sender", "sha", "group_size", "keep_id",
                      F.when(F.col("sender") == F.col("best.sender"), -F.col("best.back")).alias(
                          "first")))
    copies = slim.join(shares, ["sender", "sha"]).select(
        "sender", "row", "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("first"), F.lit(False)).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return alone.unionByName(copies)


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any other columns): doc_id,
    keep_id, group_size, kept, text_sha256.

    Texts are equal when the same bytes remain after lower-casing A-Z; a missing
    text counts as empty, so all empty and missing texts are one group. Of a
    group the row with the largest doc_id stays (``keep_id``); a missing doc_id
    is smaller than any other, and in a group without ids ``keep_id`` is
    missing. Of rows that repeat that doc_id exactly one is kept. Every row counts in
    ``group_size``. An empty table gives no rows.
    """
    return _grouped(located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))).drop(
        "sender", "row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`find` keeps, with all their columns."""
    rows = located(docs)
    gone = materialize(_grouped(rows).where(~F.col("kept")).select(
        F.col("sender").alias(SENDER), F.col("row").alias(ROW)), "gone")
    return rows.join(gone, [SENDER, ROW], "left_anti").drop(SENDER, ROW)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
