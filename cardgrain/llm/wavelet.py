"""Token ids in wavelet-matrix files with rank and select.

One file holds a run of documents: a zstd-compressed table of document ids and
lengths, then one bit plane for each bit of the largest id, from the highest.
A plane holds that bit of every token, in the order that the planes above it
give (tokens with a 0 first, each half in its former order). Planes are cut
into blocks of 4096 bytes that are compressed one by one, beside a directory
of the ones before each block; rank and select read the directory and one
block, so a token, a count or an occurrence is found without decoding the file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, materialize, shared_path
from cardgrain.llm.files import read_file, write_file
from cardgrain.llm.wordcache import WordEncoder

MAGIC = b"WVMX0001"
BLOCK_BITS = 1 << 15
SHARD_TOKENS = 2_000_000


def _section(raw: bytes) -> bytes:
    packed = zstandard.compress(raw, 1)
    return struct.pack("<QQ", len(raw), len(packed)) + packed


def build(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray,
          missing: np.ndarray | None = None) -> bytes:
    """File bytes for documents (ids, lengths; ``missing``: no doc_id) and their tokens."""
    ids = np.ascontiguousarray(ids, np.uint32)
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    t = ids.astype(np.uint16) if planes <= 16 else ids
    missing = np.zeros(len(lengths), bool) if missing is None else missing
    out = [MAGIC, struct.pack("<QQB", len(ids), len(lengths), planes),
           _section(np.asarray(doc_ids, "<i8").tobytes()),
           _section(np.asarray(lengths, "<u8").tobytes()),
           _section(np.packbits(missing, bitorder="little").tobytes())]
    compress = zstandard.ZstdCompressor(level=1).compress
    for b in range(planes - 1, -1, -1):
        one = (t & t.dtype.type(1 << b)) != 0
        bits = np.packbits(one, bitorder="little")
        raw = bits.tobytes()
        starts = range(0, len(raw), BLOCK_BITS // 8)
        blocks = [compress(raw[i:i + BLOCK_BITS // 8]) for i in starts]
        ones = [int(np.bitwise_count(bits[i:i + BLOCK_BITS // 8]).sum()) for i in starts]
        before = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        ends = np.concatenate([[0], np.cumsum([len(x) for x in blocks])]).astype("<u8")
        out += [struct.pack("<Q", int(ends[-1])), before.tobytes(), ends.tobytes(), *blocks]
        t = np.concatenate([t.compress(~one), t.compress(one)])
    return b"".join(out)


class WaveletMatrix:
    """Reader of one file: access, counts and occurrences, and the whole sequence."""

    def __init__(self, data):
        self.data = memoryview(data)
        if bytes(self.data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.n, self.n_docs, self.planes = struct.unpack_from("<QQB", self.data, 8)
        at = 25
        tables = []
        for _ in range(3):
            raw, packed = struct.unpack_from("<QQ", self.data, at)
            tables.append(zstandard.decompress(bytes(self.data[at + 16:at + 16 + packed]),
                                               max_output_size=max(1, raw)) if raw else b"")
            at += 16 + packed
        self.doc_ids = np.frombuffer(tables[0], "<i8")
        self.lengths = np.frombuffer(tables[1], "<u8").astype(np.int64)
        self.missing = np.unpackbits(np.frombuffer(tables[2], np.uint8), bitorder="little",
                                     count=self.n_docs).astype(bool)
        blocks = -(-self.n // BLOCK_BITS)
        self.before, self.ends, self.at = [], [], []
        for _ in range(self.planes):
            (size,) = struct.unpack_from("<Q", self.data, at)
            at += 8
            for table in (self.before, self.ends):
                table.append(np.frombuffer(self.data, "<u8", blocks + 1, at).astype(np.int64))
                at += 8 * (blocks + 1)
            self.at.append(at)
            at += size
        self._read = zstandard.ZstdDecompressor()

    def _block(self, plane: int, k: int) -> np.ndarray:
        a, e = self.at[plane], self.ends[plane]
        raw = self._read.decompress(self.data[a + e[k]:a + e[k + 1]],
                                    max_output_size=BLOCK_BITS // 8)
        return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little",
                             count=min(BLOCK_BITS, self.n - k * BLOCK_BITS))

    def _zeros(self, plane: int) -> int:
        return self.n - int(self.before[plane][-1])

    def _rank1(self, plane: int, i: int) -> int:
        k, rest = divmod(i, BLOCK_BITS)
        inside = int(self._block(plane, k)[:rest].sum()) if rest else 0
        return int(self.before[plane][k]) + inside

    def _select(self, plane: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) ``bit`` of a plane."""
        before = self.before[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        k = int(np.searchsorted(before, j, "right")) - 1
        return k * BLOCK_BITS + int(np.flatnonzero(
            self._block(plane, k) == bit)[j - int(before[k])])

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            k, rest = divmod(i, BLOCK_BITS)
            block = self._block(p, k)
            bit, ones = int(block[rest]), int(self.before[p][k]) + int(block[:rest].sum())
            value = value << 1 | bit
            i = self._zeros(p) + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if token < 0 or token >> self.planes:
            return 0, 0
        for p in range(self.planes):
            a, b = self._rank1(p, start), self._rank1(p, stop)
            if token >> (self.planes - 1 - p) & 1:
                start, stop = self._zeros(p) + a, self._zeros(p) + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of ``token`` among the positions from ``start`` up to ``stop``."""
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def occurrence(self, token: int, j: int) -> int:
        """Position of the ``j``-th (from 0) occurrence of ``token``."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for p in range(self.planes - 1, -1, -1):
            if token >> (self.planes - 1 - p) & 1:
                i = self._select(p, 1, i - self._zeros(p))
            else:
                i = self._select(p, 0, i)
        return i

    def decode(self) -> np.ndarray:
        """All tokens, by undoing the planes from the lowest."""
        dtype = np.uint16 if self.planes <= 16 else np.uint32
        t = np.zeros(self.n, dtype)
        for p in range(self.planes - 1, -1, -1):
            parts = [self._block(p, k) for k in range(len(self.ends[p]) - 1)]
            one = np.concatenate(parts).view(bool) if parts else np.zeros(0, bool)
            up, z = np.empty_like(t), self._zeros(p)
            up[np.flatnonzero(~one)] = t[:z]
            up[np.flatnonzero(one)] = t[z:] | dtype(1 << (self.planes - 1 - p))
            t = up
        return t.astype(np.uint32)


MANIFEST = "part int, k int, path string, n_docs long, n_tokens long"


def write_shards(docs: DataFrame, tokenizer: str, end_id: int,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every whole text and write the token files; returns their manifest
    (part, k, path, n_docs, n_tokens), in whose order doc_id ascends.

    Rows are dealt by ranges of doc_id and sorted (missing ids first). Null
    and empty texts have the end id alone; repeated rows are written once
    each; a file holds whole documents, up to ``shard_tokens`` tokens or one
    longer document. Tasks write files under names of their own, and only the
    manifest of the successful attempts counts. An empty table has no files;
    other columns are not read.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "tokens")
    end = np.uint32(end_id).tobytes()

    def run(batches):
        encoder = WordEncoder.of(tokenizer)
        part = TaskContext.get().partitionId()
        k, held, ids = 0, [], []

        def flush():
            path = f"{folder}/{part:06d}-{k:06d}-{uuid.uuid4().hex}.wvm"
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            write_file(path, build(np.frombuffer(b"".join(ids), "<u4"),
                                   np.array([d or 0 for d in held], np.int64), lengths,
                                   np.array([d is None for d in held], bool)))
            return {"part": [part], "k": [k], "path": [path], "n_docs": [len(held)],
                    "n_tokens": [int(lengths.sum())]}

        size = 0
        for b in batches:
            for doc_id, x in zip(b["doc_id"], encoder.encode(b["text"])):
                x += end
                if held and size + len(x) > 4 * shard_tokens:
                    yield flush()
                    k, held, ids, size = k + 1, [], [], 0
                held.append(doc_id)
                ids.append(x)
                size += len(x)
        if held:
            yield flush()

    rows = (docs.select(F.col("doc_id").cast("long"), "text")
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    return materialize(arrow_map(rows, run, MANIFEST), "manifest")


def _starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first``: the tokens of all files before."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.select(F.col("part").alias("p"), (F.sum("total").over(
        Window.orderBy("part")) - F.col("total")).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("k"))
    return manifest.withColumn("first", inside - F.col("n_tokens")).join(
        parts, F.col("part") == F.col("p")).select(
        "path", (F.col("first") + F.col("base")).alias("first"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, read back from the files."""
    def run(batches):
        for b in batches:
            for path, first in zip(b["path"], b["first"]):
                w = WaveletMatrix(read_file(path))
                raw = w.decode()
                stops = np.cumsum(w.lengths)
                for i in range(0, w.n_docs, 1000):
                    docs = range(i, min(i + 1000, w.n_docs))
                    yield {"doc_id": [None if w.missing[d] else int(w.doc_ids[d]) for d in docs],
                           "start": [first + int(stops[d] - w.lengths[d]) for d in docs],
                           "ids": [raw[stops[d] - w.lengths[d]:stops[d]].astype(np.int32)
                                   for d in docs]}

    return arrow_map(_spread(manifest), run, "doc_id long, start long, ids array<int>")


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches):
        for b in batches:
            for path, first in zip(b["path"], b["first"]):
                w = WaveletMatrix(read_file(path))
                raw = memoryview(w.decode().astype("<u4").tobytes())
                stops = np.cumsum(w.lengths)
                starts = stops - w.lengths
                yield {"doc_id": [None if m else int(d) for m, d in zip(w.missing, w.doc_ids)],
                       "start": (starts + first).tolist(), "n_tokens": w.lengths.tolist(),
                       "ids_crc32": [zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(
                           starts.tolist(), stops.tolist())]}

    return arrow_map(_spread(manifest), run,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """(doc_id, position): every place of one token, found by rank and select."""
    def run(batches):
        for b in batches:
            for path in b["path"]:
                w = WaveletMatrix(read_file(path))
                at = np.array([w.occurrence(token, j) for j in range(w.count(token))], np.int64)
                stops = np.cumsum(w.lengths)
                doc = np.searchsorted(stops, at, "right")
                yield {"doc_id": [None if w.missing[d] else int(w.doc_ids[d]) for d in doc],
                       "position": (at - (stops - w.lengths)[doc]).tolist()}

    return arrow_map(_spread(manifest), run, "doc_id long, position long")


def _spread(manifest: DataFrame) -> DataFrame:
    """Files dealt evenly: one file is one row, whatever its size."""
    files = manifest.count()
    out = _starts(manifest)
    return out.repartition(max(1, files), "path") if files else out
