"""Language-model scoring with an n-gram trie in Elias-Fano levels.

Level 1 holds every training word (its 63-bit hash) and its count; a word's rank is
its place there. Level n holds, for every context of n-1 words, the words that
followed it. A context is named by the place of its entry in level n-1 and not
stored: monotone pointers, one per place, lead to its children. Children are
word ranks relative to their context (place of the context in the file, then rank: one
ascending sequence), beside a quantised discounted probability for each child, a
quantised rest for each context and, in levels below the last, short counts.
Levels are cut into files by ranges of (context, child) of about equal
training tokens, written by tasks into the shared folder and memory-mapped where they
are queried.

p(w | context) = discounted(context, w) + rest(context) * p(w | shorter context),
down to p(w) = (c + 0.1) / (N + 0.1 (V + 1)); the rest of a context is what its
stored children leave, so probabilities sum to one up to quantisation.
"""

from __future__ import annotations

import mmap
import struct
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm import eliasfano
from cardgrain.llm.common import arrow_map, materialize, shared_path
from cardgrain.llm.eliasfano import EliasFano
from cardgrain.llm.files import read_file, write_file

ORDER = 3
DISCOUNT = 0.5
ADD = 0.1
SHARD_TOKENS = 2_000_000  # training tokens for each file of a level
FLUSH = 6_000_000  # bytes of text counted or scored at once in a task
SCALE, ZERO = 6500.0, 65535  # quantised -log10
MASK63 = np.uint64((1 << 63) - 1)
HELD = 1 << 28  # bytes of files not mapped that a worker keeps
SPACE63 = 1 << 63
END = np.uint64(xxhash.xxh64_intdigest(b" ")) & MASK63  # no word has a space


@dataclass
class Tokens:
    """Words of a run of whole texts, each text's end after them: the ascending
    ``distinct`` hashes, each token's place among them, each text's first token."""

    distinct: np.ndarray
    code: np.ndarray
    first: np.ndarray

    @property
    def hashes(self) -> np.ndarray:
        return self.distinct[self.code]

    @property
    def is_end(self) -> np.ndarray:
        return self.code == np.searchsorted(self.distinct, END)


def tokens(texts: pa.Array) -> Tokens:
    """Tokens of whole texts (A-Z lower-cased, cut at ASCII white space; null:
    empty); each distinct word is hashed once."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    parts = pc.ascii_split_whitespace(texts)
    coded = parts.flatten().dictionary_encode()
    found = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    code = coded.indices.to_numpy()
    stop = np.cumsum(pc.list_value_length(parts).to_numpy().astype(np.int64))
    if "" in found:  # white space at either end of a text
        word = code != found.index("")
        stop = np.concatenate([[0], np.cumsum(word)])[stop]
        code = code[word]
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)) & MASK63
    distinct, place = np.unique(np.append(h, END), return_inverse=True)
    code = np.insert(place[code], stop, place[-1])
    used = np.bincount(code, minlength=len(distinct)) > 0  # "" is no word
    if not used.all():
        code, distinct = (np.cumsum(used) - 1)[code], distinct[used]
    return Tokens(distinct, code, np.concatenate([[0], stop[:-1] + np.arange(1, len(stop))]))


def quantise(p: np.ndarray) -> np.ndarray:
    q = np.full(len(p), ZERO, np.uint16)
    some = p > 0
    q[some] = np.clip(np.round(-np.log10(p[some]) * SCALE), 0, ZERO - 1)
    return q


_RESTORED = np.concatenate([10.0 ** (-np.arange(ZERO) / SCALE), [0.0]])


def restore(q: np.ndarray) -> np.ndarray:
    return _RESTORED[q]


def _section(a: np.ndarray) -> bytes:
    raw = a.tobytes()
    return struct.pack("<Q", len(a)) + raw + b"\0" * (-len(raw) % 8)


def _read(data, at: int, dtype: str):
    (n,) = struct.unpack_from("<Q", data, at)
    a = np.frombuffer(data, dtype, n, at + 8)
    return a, at + 8 + -(-n * a.itemsize // 8) * 8


class WordFile:
    """A file of level 1: word hashes and counts."""

    @staticmethod
    def build(h: np.ndarray, count: np.ndarray) -> bytes:
        return eliasfano.build(h, SPACE63) + _counts(count)

    def __init__(self, data):
        self.words = EliasFano(data)
        self.counts = Counts(data, self.words.stop)

    def look(self, h: np.ndarray):
        """(count, place) of each hash; place -1 and count 0 where it is not there."""
        at = self.words.find(h)
        return self.counts.of(at), at


def _counts(count: np.ndarray) -> bytes:
    """Counts in a byte each; those of 255 or more in a list of their own."""
    large = np.flatnonzero(count >= 255)
    return (_section(np.minimum(count, 255).astype("<u1")) + _section(large.astype("<u8"))
            + _section(count[large].astype("<u8")))


class Counts:
    def __init__(self, data, at: int):
        self.small, at = _read(data, at, "<u1")
        self.places, at = _read(data, at, "<u8")
        self.large, self.stop = _read(data, at, "<u8")

    def of(self, at: np.ndarray) -> np.ndarray:
        """Count at each place; 0 at place -1."""
        if not len(self.small):
            return np.zeros(len(at), np.int64)
        out = np.where(at >= 0, self.small[at].astype(np.int64), 0)
        big = np.flatnonzero(out == 255)
        out[big] = self.large[np.searchsorted(self.places, at[big])]
        return out


class GramFile:
    """A file of level n: pointers, children, probabilities, rests, counts."""

    @staticmethod
    def build(first: int, stop: int, shift: int, parent: np.ndarray, child: np.ndarray, p: np.ndarray,
              rest: np.ndarray, count: np.ndarray | None) -> bytes:
        """Entries ascending by (parent, child), of the parents from ``first`` up to ``stop``;
        ``rest`` for each of these; ``count`` if a next level needs it."""
        pointers = np.searchsorted(parent, np.arange(first, stop + 1, dtype=np.uint64))
        relative = ((parent - np.uint64(first)) << np.uint64(shift)) | child
        return b"".join([struct.pack("<QQ", first, shift),
                         eliasfano.build(pointers.astype(np.uint64), len(parent) + 1),
                         eliasfano.build(relative, max(1, stop - first) << shift),
                         _section(quantise(p)), _section(quantise(rest)),
                         _counts(count if count is not None else np.zeros(0, np.int64))])

    def __init__(self, data):
        first, shift = struct.unpack_from("<QQ", data)
        self.first, self.shift = np.uint64(first), np.uint64(shift)
        self.pointers = EliasFano(data, 16)
        self.children = EliasFano(data, self.pointers.stop)
        self.p, at = _read(data, self.children.stop, "<u2")
        self.rest, at = _read(data, at, "<u2")
        self.counts = Counts(data, at)

    def look(self, distinct: np.ndarray, sizes: np.ndarray, child: np.ndarray):
        """(rest, p, count, place) of entries given as runs: ``sizes`` children of each of the
        ascending ``distinct`` parents. A last level has no counts: 1 for each entry."""
        local = distinct - self.first
        rest = np.repeat(restore(self.rest[local.astype(np.int64)]), sizes)
        at = self.children.find((np.repeat(local, sizes) << self.shift) | child)
        hit = at >= 0
        p = np.where(hit, restore(self.p[at]), 0.0) if len(self.p) else np.zeros(len(at))
        count = self.counts.of(at) if len(self.counts.small) else hit.astype(np.int64)
        return rest, p, count, at

    def followers(self, parent: int) -> np.ndarray:
        """Word ranks of a context's stored children."""
        at = np.array([parent - int(self.first)])
        a, b = (int(self.pointers.access(at + i)[0]) for i in (0, 1))
        return self.children.access(np.arange(a, b)) & ((np.uint64(1) << self.shift) - np.uint64(1))


@dataclass
class Level:
    """Files of one level: the (parent, child) that each starts at and the entries before it."""

    parents: np.ndarray
    children: np.ndarray
    paths: list
    before: np.ndarray | None = None
    size: int = 0
    whole_rest: dict = field(default_factory=dict)   # of contexts cut over several files
    whole_count: dict = field(default_factory=dict)

    def of(self, distinct: np.ndarray) -> np.ndarray:
        """File number of each ascending context; -1 for one cut over several files."""
        at = np.searchsorted(self.parents, distinct, "right") - 1
        cut = np.unique(self.parents[self.children > 0])
        if len(cut):
            k = np.minimum(np.searchsorted(cut, distinct), len(cut) - 1)
            at[cut[k] == distinct] = -1
        return at

    def shard(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """File number of each entry: the last start at or below it."""
        at = np.searchsorted(self.parents, parent, "right") - 1
        first = np.searchsorted(self.parents, parent, "left")
        cut = np.flatnonzero(at > first)  # several files start in this context
        for c in np.unique(parent[cut]).tolist():
            mine = cut[parent[cut] == c]
            a, b = np.searchsorted(self.parents, [c, c + 1])
            at[mine] = a + np.searchsorted(self.children[a:b], child[mine], "right") - 1
        return at

    def parents_of(self, shard: int, all_parents: int) -> tuple[int, int]:
        """The parents (from, up to) that a file has entries of."""
        first = int(self.parents[shard])
        if shard + 1 == len(self.parents):
            return first, max(all_parents, first + 1)
        return first, int(self.parents[shard + 1]) + int(self.children[shard + 1] > 0)

    def sized(self, sizes: list[int]) -> None:
        self.before = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        self.size = int(self.before[-1])


def starts(edges: set[int], hot: list[tuple[int, int]], per_shard: int, words: int) -> Level:
    """Files from each parent of ``edges`` on; a context with over ``per_shard`` tokens (hot:
    (parent, tokens)) is cut into even ranges of its children."""
    at = {(e, 0) for e in edges | {0}}
    for parent, n in hot:
        parts = min(-(-n // per_shard), max(1, words))
        at |= {(parent, i * words // parts) for i in range(parts)}
    at = sorted(at)
    return Level(np.array([e[0] for e in at], np.uint64), np.array([e[1] for e in at], np.uint64),
                 [None] * len(at), whole_count=dict(hot))


@dataclass
class Model:
    """The trie: totals and levels; files are opened where they are queried."""

    total: int
    distinct: int
    levels: list

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    @property
    def shift(self) -> int:
        """Bits of a word rank; the rank ``distinct`` stands for an unknown word."""
        return max(1, int(self.distinct).bit_length())

    def _file(self, level: int, shard: int):
        """An opened file. Mapped files stay open; of others the last used, up to ``HELD`` bytes."""
        cache = self.__dict__.setdefault("_open", OrderedDict())
        key = level, int(shard)
        if key not in cache:
            path = self.levels[level].paths[key[1]]
            if path is None:
                return None
            data = read_file(path)
            size = 0 if isinstance(data.obj, mmap.mmap) else data.nbytes
            cache[key] = (GramFile if level else WordFile)(data), size
            while len(cache) > 1 and sum(n for _, n in cache.values()) > HELD:
                cache.popitem(last=False)
        cache.move_to_end(key)
        return cache[key][0]

    def words(self, h: np.ndarray):
        """(count, rank) of each word hash (ascending); rank ``distinct`` if unknown."""
        count, rank = np.zeros(len(h), np.int64), np.full(len(h), self.distinct, np.int64)
        level = self.levels[0]
        where = level.shard(h, np.zeros(len(h), np.uint64))
        for s in np.unique(where).tolist():
            f = self._file(0, s)
            if f is not None:
                mine = np.flatnonzero(where == s)
                count[mine], at = f.look(h[mine])
                rank[mine] = np.where(at >= 0, at + level.before[s], self.distinct)
        return count, rank

    def look(self, n: int, parent: np.ndarray, child: np.ndarray):
        """(rest, p, count, place) of entries of level n, in any order; place -1: not there."""
        level = self.levels[n - 1]
        order = _order(parent, child, self.shift)
        parent, child = parent[order], child[order]
        once = np.flatnonzero(np.concatenate([[True], (parent[1:] != parent[:-1]) |
                                              (child[1:] != child[:-1])]))
        times = np.diff(np.concatenate([once, [len(order)]]))
        parent, child = parent[once], child[once]
        rest, p = np.ones(len(once)), np.zeros(len(once))
        count, place = np.zeros(len(once), np.int64), np.full(len(once), -1, np.int64)

        def ask(shard: int, distinct, sizes, at):
            f = self._file(n - 1, shard)
            if f is not None:
                rest[at], p[at], count[at], found = f.look(distinct, sizes, child[at])
                place[at] = np.where(found >= 0, found + level.before[shard], -1)

        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        distinct, stop = parent[first], np.concatenate([first[1:], [len(once)]])
        where = level.of(distinct)
        alone = where >= 0
        for k in np.flatnonzero(~alone).tolist():  # contexts cut over several files
            at = np.arange(first[k], stop[k])
            shard = level.shard(parent[at], child[at])
            for s in np.unique(shard).tolist():
                mine = at[shard == s]
                ask(s, distinct[k:k + 1], np.array([len(mine)]), mine)
            rest[at] = level.whole_rest.get(int(distinct[k]), 1.0)
        keep = np.flatnonzero(alone)
        cuts = np.flatnonzero(np.diff(where[keep])) + 1
        for part in np.split(keep, cuts) if len(keep) else ():
            a, b = part[0], part[-1] + 1
            if b - a == len(part):
                ask(where[a], distinct[a:b], (stop - first)[a:b], slice(first[a], stop[b - 1]))
            else:  # a cut context lies between
                sizes = (stop - first)[part]
                at = np.repeat(first[part], sizes) + np.arange(sizes.sum()) - np.repeat(
                    np.cumsum(sizes) - sizes, sizes)
                ask(where[a], distinct[part], sizes, at)
        out = tuple(np.empty(len(order), x.dtype) for x in (rest, p, count, place))
        for to, x in zip(out, (rest, p, count, place)):
            to[order] = np.repeat(x, times)
        return out

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + ADD) / (self.total + ADD * (self.distinct + 1))

    def grams(self, t: Tokens, upto: int):
        """Per token: probability after each order, and the stored contexts.

        Yields (n, place of each token's context of n-1 words, whether it is in
        the trie, counts, probability) level by level; counts of the last
        level tell only whether the n-gram is there.
        """
        for n, parent, live, count, p, _ in self._levels(t, upto, *self.words(t.distinct)):
            yield n, parent, live, count, p

    def _levels(self, t: Tokens, upto: int, count: np.ndarray, rank: np.ndarray):
        """:meth:`grams` with the place of the n words up to each token, -1 where there is none."""
        is_end = t.is_end
        word = rank[t.code]
        p = self.base(count)[t.code]
        place = np.where(word < self.distinct, word, -1)
        yield 1, None, None, count[t.code], p, place
        for n in range(2, upto + 1):
            parent, live = np.zeros(len(word), np.int64), np.zeros(len(word), bool)
            parent[1:], live[1:] = place[:-1], (place[:-1] >= 0) & ~is_end[:-1]
            at = np.flatnonzero(live)
            if not len(at):
                return
            rest, q, c, found = self.look(n, parent[at].astype(np.uint64), word[at].astype(np.uint64))
            p = p.copy()
            p[at] = q + rest * p[at]
            full, place = np.zeros(len(word), np.int64), np.full(len(word), -1, np.int64)
            full[at], place[at] = c, found
            yield n, parent, live, full, p, place


def _flushes(batches):
    """Runs of whole rows with ``FLUSH`` bytes of text, or one longer text."""
    held, size = [], 0
    for b in batches:
        a = 0
        lengths = pc.fill_null(pc.binary_length(b["text"]), 0).to_pylist()
        for i, n in enumerate(lengths):
            size += n
            if size >= FLUSH:
                yield pa.Table.from_batches([*held, b.slice(a, i + 1 - a)])
                held, size, a = [], 0, i + 1
        if a < len(lengths):
            held.append(b.slice(a))
    if held:
        yield pa.Table.from_batches(held)


def _texts(run: pa.Table) -> pa.Array:
    return pa.concat_arrays(c.cast(pa.large_string()) for c in run["text"].chunks)


def _count_words(docs: DataFrame) -> DataFrame:
    def run(batches):
        for texts in _flushes(batches):
            t = tokens(_texts(texts))
            word, n = t.distinct, np.bincount(t.code)
            for i in range(0, len(word), 100_000):
                yield {"h": word[i:i + 100_000].view(np.int64), "n": n[i:i + 100_000]}

    return materialize(arrow_map(docs.select("text"), run, "h long, n long", plain=False)
                       .groupBy("h").agg(F.sum("n").alias("n")), "words")


def _by_shard(batches, *columns: str):
    """(shard, {column: values}) of each run of rows with one shard."""
    now, held = None, None
    for b in batches:
        for i, s in enumerate(b["shard"]):
            if s != now:
                if held is not None:
                    yield now, held
                now, held = s, {c: [] for c in columns}
            for c in columns:
                held[c].append(b[c][i])
    if held is not None:
        yield now, held


def _word_level(counts: DataFrame, shards: int) -> Level:
    bits = (shards - 1).bit_length()  # files by the first bits of the hash
    n = 1 << bits
    level = Level(np.array([i * SPACE63 // n for i in range(n)], np.uint64), np.zeros(n, np.uint64),
                  [None] * n)
    folder = shared_path(counts.sparkSession, "level1")

    def write(batches):
        for s, rows in _by_shard(batches, "h", "n"):
            path = f"{folder}/{s:07d}-{uuid.uuid4().hex}.words"
            h = np.array(rows["h"], np.int64).view(np.uint64)
            order = np.argsort(h)
            write_file(path, WordFile.build(h[order], np.array(rows["n"], np.int64)[order]))
            yield {"shard": [s], "path": [path], "size": [len(h)]}

    rows = counts.withColumn("shard", F.shiftright("h", 63 - bits).cast("int") if bits
                             else F.lit(0))
    made = arrow_map(rows.repartition("shard").sortWithinPartitions("shard"), write,
                     "shard int, path string, size long").collect()  # a row for each file
    sizes = [0] * n
    for r in made:
        level.paths[r["shard"]], sizes[r["shard"]] = r["path"], r["size"]
    level.sized(sizes)
    return level


def _planes(a: np.ndarray) -> bytes:
    """Bytes by significance: those that are zero throughout compress to nothing."""
    return a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T.copy().view("<u8").ravel()


def _blob(parent: np.ndarray, child: np.ndarray, count: np.ndarray) -> bytes:
    """Entries ascending by (parent, child): steps between parents, their numbers of children, children, counts."""
    distinct, first = np.unique(parent, return_index=True)
    sizes = np.diff(np.concatenate([first, [len(parent)]]))
    raw = struct.pack("<QQ", len(distinct), len(child)) + b"".join(map(_planes, (
        np.diff(distinct, prepend=np.uint64(0)), sizes, child, count)))
    return zstandard.compress(raw, 1)


def _unblob(blob: bytes):
    raw = zstandard.decompress(blob)
    m, n = struct.unpack_from("<QQ", raw)
    steps, sizes = _unplanes(raw, m, 16), _unplanes(raw, m, 16 + 8 * m)
    child, count = (_unplanes(raw, n, 16 + 16 * m + 8 * i * n) for i in range(2))
    return np.repeat(np.cumsum(steps, dtype=np.uint64), sizes.astype(np.int64)), child, count.astype(np.int64)


def _order(parent: np.ndarray, child: np.ndarray, shift: int) -> np.ndarray:
    """Sorts by (parent, child), in one key where both fit into it."""
    if not len(parent) or int(parent.max()).bit_length() + shift <= 64:
        return np.argsort((parent << np.uint64(shift)) | child)
    return np.lexsort((child, parent))


def _summed(parent: np.ndarray, child: np.ndarray, count: np.ndarray, shift: int):
    order = _order(parent, child, shift)
    parent, child, count = parent[order], child[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], (parent[1:] != parent[:-1]) | (child[1:] != child[:-1])]))
    return parent[new], child[new], np.add.reduceat(count, new)


def _count_pairs(t: Tokens, rank: np.ndarray, at: np.ndarray):
    """Entries of level 2 (parent, child, count) for the tokens ``at``, by places among the
    distinct words, whose order is that of their ranks."""
    key, total = np.unique((t.code[at - 1].astype(np.uint64) << np.uint64(32)) | t.code[at].astype(np.uint64),
                           return_counts=True)
    rank = rank.astype(np.uint64)
    return rank[(key >> np.uint64(32)).astype(np.int64)], rank[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)], total


def _discounted(parent: np.ndarray, total: np.ndarray, whole_count: dict):
    """Of entries of a file by parent: (probability of each entry; the distinct parents,
    what their entries use of their counts, and these counts)."""
    distinct, first = np.unique(parent, return_index=True)
    sizes = np.diff(np.concatenate([first, [len(parent)]]))
    of = np.add.reduceat(total, first)  # every occurrence of a context is followed by a word or an end
    for i in np.flatnonzero(np.isin(distinct, np.array(sorted(whole_count), np.uint64))).tolist():
        of[i] = whole_count[int(distinct[i])]
    return (total - DISCOUNT) / np.repeat(of, sizes), distinct, np.add.reduceat(total - DISCOUNT, first), of


def _gram_level(docs: DataFrame, model: Model, n: int, level: Level, shard_tokens: int, last: bool):
    """Level n from whole texts: tasks count n-grams, one blob for each file they
    touch; a task for each file adds them up. Returns the next level's starts."""
    folder, shift = shared_path(docs.sparkSession, f"level{n}"), model.shift
    all_parents = model.levels[-1].size

    def count(batches):
        for texts in _flushes(batches):
            t = tokens(_texts(texts))
            inner = ~t.is_end[:-1]
            words, rank = model.words(t.distinct)
            if n == 2:
                at = np.flatnonzero(inner) + 1
                entries = len(at) and _count_pairs(t, rank, at)
            else:
                for m, *_, place in model._levels(t, n - 1, words, rank):
                    pass
                # A word after a place of n-1 words is its child.
                at = np.flatnonzero((place[:-1] >= 0) & inner) + 1 if m == n - 1 else []
                entries = len(at) and _summed(
                    place[at - 1].astype(np.uint64), rank[t.code[at]].astype(np.uint64),
                    np.ones(len(at), np.int64), shift)
            if not len(at):
                continue
            parent, child, total = entries
            where = level.shard(parent, child)
            cuts = np.flatnonzero(np.diff(where)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(where)]):
                yield {"shard": [int(where[a])], "blob": [_blob(parent[a:b], child[a:b], total[a:b])]}

    def write(batches):
        cut = np.unique(level.parents[level.children > 0])
        end = int(model.words(np.array([END]))[1][0])
        for s, rows in _by_shard(batches, "blob"):
            parent, child, total = _summed(*map(np.concatenate, zip(*map(_unblob, rows["blob"]))), shift)
            p, distinct, used, of = _discounted(parent, total, level.whole_count)
            first, stop = level.parents_of(s, all_parents)
            rest = np.ones(stop - first)
            rest[(distinct - np.uint64(first)).astype(np.int64)] = 1 - used / of
            path = f"{folder}/{s:07d}-{uuid.uuid4().hex}.grams"
            write_file(path, GramFile.build(first, stop, shift, parent, child, p, rest, None if last else total))
            edge = np.isin(distinct, cut)
            followed = np.where(child == end, 0, total)
            steps, large = np.cumsum(followed) // shard_tokens, np.flatnonzero(followed > shard_tokens)
            turns = np.flatnonzero(np.diff(steps, prepend=0)) if not last else []
            yield {"shard": [s], "path": [path], "size": [len(parent)],
                   "cut": [[(int(c), float(u), int(k)) for c, u, k in zip(distinct[edge], used[edge], of[edge])]],
                   "turns": [[int(x) for x in turns]],
                   "hot": [[(int(i), int(total[i])) for i in large] if not last else []]}

    blobs = arrow_map(docs.select("text"), count, "shard int, blob binary", plain=False)
    made = arrow_map(
        blobs.repartition("shard").sortWithinPartitions("shard"), write,
        "shard int, path string, size long, cut array<struct<c:long,u:double,k:long>>, turns array<long>, "
        "hot array<struct<i:long,k:long>>").collect()  # a row for each file
    sizes, used = [0] * len(level.paths), {}
    for r in made:
        level.paths[r["shard"]], sizes[r["shard"]] = r["path"], r["size"]
        for c, u, k in r["cut"]:
            used.setdefault(c, [0.0, k])[0] += u
    level.sized(sizes)
    level.whole_rest = {c: 1 - u / k for c, (u, k) in used.items()}
    before = {r["shard"]: int(level.before[r["shard"]]) for r in made}
    edges = {before[r["shard"]] + i for r in made for i in [0, *r["turns"]]}
    hot = [(before[r["shard"]] + i, k) for r in made for i, k in r["hot"]]
    return starts(edges, hot, shard_tokens, model.distinct)


def learn(docs: DataFrame, order: int = ORDER, shard_tokens: int = SHARD_TOKENS) -> Model:
    """The trie of all whole texts of ``docs`` (text; null: empty)."""
    counts = _count_words(docs)
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    shards = max(1, -(-total // shard_tokens))
    model = Model(total, distinct, [_word_level(counts, max(1, -(-distinct // shard_tokens)))])
    # words seen over shard_tokens times: at most total / shard_tokens rows
    hot = {r["h"]: r["n"] for r in counts.where(
        (F.col("n") > shard_tokens) & (F.col("h") != int(END))).collect()}
    _, ranks = model.words(np.array(sorted(hot), np.uint64))
    level = starts({i * distinct // shards for i in range(shards)},
                   [(int(r), hot[h]) for h, r in zip(sorted(hot), ranks)], shard_tokens, distinct)
    for n in range(2, order + 1):
        after = _gram_level(docs, model, n, level, shard_tokens, n == order)
        model.levels.append(level)
        level = after
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Whole texts, null as empty (the end token alone). base_score: log10
    probability by words alone; score: by the trie. Repeated rows repeat; an
    empty table gives no rows; with nothing learned every token has
    probability 1; other columns are not read.
    """
    order = len(model.levels)

    def run(batches):
        for rows in _flushes(batches):
            t = tokens(_texts(rows))
            for m, _, _, counts, p in model.grams(t, order):
                if m == 1:
                    known = np.add.reduceat(counts > 0, t.first, dtype=np.int64)
                    base = np.add.reduceat(np.log10(p), t.first)
            yield {"doc_id": rows["doc_id"].to_pylist(),
                   "n_tokens": np.diff(np.append(t.first, len(t.code))),
                   "n_known": known, "train_tokens": [model.total] * len(rows),
                   "base_score": base, "score": np.add.reduceat(np.log10(p), t.first)}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, n_tokens long, n_known long, train_tokens long, "
                     "base_score double, score double", plain=False)
