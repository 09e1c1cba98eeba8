"""Harmonic packing of token sequences into fixed-size training sequences.

Lengths fall into reciprocal-capacity classes: class k holds pieces of length
in (capacity/(k+1), capacity/k], and every k pieces of a class fill one
sequence. A document is cut so that its pieces fit their classes exactly:
whole capacities first, then capacity/2, capacity/4, ... down to
``least_cut``; the rest (shorter than ``least_cut``) is one piece, which
wastes under 1/k of its sequence. Every worker fills the classes of its own
input partition, with no exchange; what is left of its classes at the end is
laid end to end, cut at the capacity, and the last sequence is cut into
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map
from cardgrain.llm.wordcache import WordEncoder

LEAST_CUT = 64

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def cut(length: int, capacity: int, least_cut: int) -> list[int]:
    """Piece lengths of a document of ``length`` ids, in order."""
    out = [capacity] * (length // capacity)
    rest, size = length % capacity, capacity // 2
    while size >= least_cut:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class Packer:
    """Fills the classes of one worker. A piece is (doc_id, doc_tokens, start, ids): it
    holds its own ids only, so what is open is less than a sequence for each class."""

    def __init__(self, capacity: int, least_cut: int, first_id: int):
        self.capacity, self.least_cut, self.next_id = capacity, least_cut, first_id
        self.open: dict[int, list] = defaultdict(list)

    def _close(self, pieces: list) -> list:
        out, at = [], 0
        for doc_id, total, start, ids in pieces:
            n = len(ids) // 4
            out.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, at))
            at += n
        self.next_id += 1
        return out

    def add(self, doc_id, ids: bytes) -> list:
        """Rows of the pieces of the sequences that this document completes."""
        out, start, total = [], 0, len(ids) // 4
        for n in cut(total, self.capacity, self.least_cut):
            k = self.capacity // n
            self.open[k].append((doc_id, total, start, bytes(ids[4 * start:4 * (start + n)])))
            start += n
            if len(self.open[k]) == k:
                out += self._close(self.open.pop(k))
        return out

    def rest(self) -> list:
        """Rows of the sequences that the open classes make at the end."""
        out, now, room = [], [], self.capacity
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(len(p[3]) // 4 for p in left)
        self.open.clear()
        for doc_id, tokens, start, ids in left:
            while ids:
                if room == self.capacity and total < self.capacity:  # the last: powers of two
                    room = 1 << (total.bit_length() - 1)
                take = min(len(ids) // 4, room)
                now.append((doc_id, tokens, start, ids[:4 * take]))
                start, ids, room, total = start + take, ids[4 * take:], room - take, total - take
                if room == 0:
                    out += self._close(now)
                    now, room = [], self.capacity
        return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048,
         least_cut: int = LEAST_CUT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file for its whole text
    (special tokens' names are those tokens, as the library reads them), then ``end_id``; null and empty
    texts have that id alone. Documents may be cut anywhere; each id lies in
    exactly one piece and a sequence holds ``capacity`` ids at most, gapless
    from offset 0. Repeated rows are packed once each; a null doc_id stays
    null; an empty table gives no pieces; other columns are not read.
    sequence_id is the worker's partition number times 2**33 plus a count, so
    a repeated task gives the same ids.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[dict]):
        encoder = WordEncoder.of(tokenizer)
        packer = Packer(capacity, least_cut, TaskContext.get().partitionId() << 33)
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

        def rows(placed):
            return dict(zip(names, map(list, zip(*placed)) if placed else [[] for _ in names]))

        for b in batches:
            done = []
            for doc_id, ids in zip(b["doc_id"], encoder.encode(b["text"])):
                done += packer.add(doc_id, ids + end)
            yield rows(done)
        yield rows(packer.rest())

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, PIECES)
