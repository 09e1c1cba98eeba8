"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The texts of a batch are cut into units (a space symbol and the characters up
to the next one: no piece but runs of spaces reaches over that border). The
units not seen before are laid end to end and indexed by a suffix array over
as many characters as the longest piece has; a binary search of every piece
gives its range of occurrences. The occurrences are edges from a piece's first
to its last character; sorted by their end, they are relaxed from left to
right: of the pieces that end at a place, the one that forms a stable pair
with the last piece before it is the last piece of the encoding so far. A pair
is stable if, with both pieces grown by merges in order of score, no merge
across their border comes first; that gives exactly the merge-by-score
encoding, as its pieces are the only sequence whose neighbours are all stable.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map

SPACE = "▁"
CACHE = 800_000  # units kept, half of them of the older generation
LONG_UNIT = 2000
UNITS = 100_000  # units indexed at once
PACK = 5  # characters in one 64-bit word of 12 bits each
NEVER = np.int64(1) << 60
TABLE = 1 << 21  # slots of the pair cache


def _merged(symbols: list[str], rank: dict[str, int]) -> list:
    """Merge neighbours by rank, leftmost first; symbols become (text, left, right, time)."""
    nodes = [(s, None, None, -1) for s in symbols]
    while len(nodes) > 1:
        best, at = None, -1
        for i in range(len(nodes) - 1):
            r = rank.get(nodes[i][0] + nodes[i + 1][0])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        a, b = nodes[at], nodes[at + 1]
        nodes[at:at + 2] = [(a[0] + b[0], a, b, max(best, a[3], b[3]))]
    return nodes


class PieceModel:
    """Tables of one model file, and encoding of unit lists."""

    _made: dict[str, PieceModel] = {}

    @classmethod
    def of(cls, path: str) -> PieceModel:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or
                                                sp.is_byte(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i) for i in plain}
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.raw = [b""] * size
        for i, p in text.items():
            self.raw[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            self.raw[i] = bytes([b])
        self.raw[self.unknown] = " ⁇ ".encode()
        self.id_of = {p: i for i, p in text.items()}
        runs = {len(p): i for i, p in text.items() if p.strip(SPACE) == ""}
        self.space_runs = runs
        words = {i: p for i, p in text.items() if i not in runs.values() or len(p) == 1}
        # higher score first; scores of pieces with other characters are all different
        order = sorted((i for i, p in words.items() if len(p) > 1),
                       key=lambda i: -sp.get_score(i))
        rank = {words[i]: r for r, i in enumerate(order)}
        alphabet = sorted(set("".join(words.values())))
        self.code = {c: k + 1 for k, c in enumerate(alphabet)}
        if len(alphabet) >= 1 << 12:
            raise ValueError("more than 4095 characters")
        self.pad_id = size  # an unknown character: no merge reaches it
        self.length = np.ones(size + 1, np.int64)
        deepest = max(map(len, words.values()))
        self.longest = deepest
        shape = (size + 1, deepest + 1)
        self.right, self.left = np.full(shape, -1, np.int64), np.full(shape, -1, np.int64)
        self.right_time, self.left_time = np.full(shape, NEVER), np.full(shape, NEVER)
        usable = []
        for i, p in words.items():
            self.length[i] = len(p)
            tree = _merged(list(p), rank)
            if len(tree) > 1 or any(c not in self.id_of for c in p):
                continue  # no merge order leads to this piece
            usable.append(i)
            for spine, times, side in ((self.right, self.right_time, 2),
                                       (self.left, self.left_time, 1)):
                chain, node = [], tree[0]
                while node is not None:
                    chain.append(node)
                    node = node[side]
                for k, node in enumerate(reversed(chain)):
                    spine[i, k], times[i, k] = self.id_of[node[0]], node[3]
        pairs, ranks = [], []
        for i in order:
            p = words[i]
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if a is not None and b is not None:
                    pairs.append(a * (size + 1) + b)
                    ranks.append(rank[p])
        by = np.argsort(np.array(pairs, np.int64))
        self.size = size
        self.pairs, self.pair_rank = np.array(pairs, np.int64)[by], np.array(ranks, np.int64)[by]
        self.piece_ids = np.array(usable, np.int64)
        self.piece_len = self.length[self.piece_ids]
        wide = -(-deepest // PACK)
        codes = np.zeros((len(usable), wide * PACK), np.uint64)
        for k, i in enumerate(usable):
            codes[k, :len(words[i])] = [self.code[c] for c in words[i]]
        top = np.where(np.arange(wide * PACK)[None, :] < self.piece_len[:, None], codes,
                       np.uint64(0xFFF))
        self.piece_low, self.piece_high = self._words(codes), self._words(top)
        self.known_pairs = np.full(TABLE, -1, np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _words(codes: np.ndarray) -> np.ndarray:
        shift = np.arange(PACK - 1, -1, -1, dtype=np.uint64) * np.uint64(12)
        return (codes.reshape(len(codes), -1, PACK) << shift).sum(2, dtype=np.uint64)

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of the pieces a and b."""
        out = np.ones(len(a), bool)
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        live = np.flatnonzero((a != self.pad_id) & (b != self.pad_id))
        while len(live):
            x, y, p, q = a[live], b[live], i[live], j[live]
            key = self.right[x, p] * (self.size + 1) + self.left[y, q]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            merges = self.pairs[at] == key
            next_l, next_r = self.right_time[x, p + 1], self.left_time[y, q + 1]
            when = np.maximum(self.pair_rank[at],
                              np.maximum(self.right_time[x, p], self.left_time[y, q]))
            broken = merges & (when < next_l) & (when <= next_r)
            out[live[broken]] = False
            step_left = next_l <= next_r
            i[live] += step_left
            j[live] += ~step_left
            live = live[~broken & ((next_l < NEVER) | (next_r < NEVER))]
        return out

    def _stable_cached(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a * (self.size + 1) + b) << 1
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        held = self.known_pairs[slot]
        miss = np.flatnonzero((held >> 1) != (key >> 1))
        if len(miss):
            pair, back = np.unique(key[miss], return_inverse=True)
            good = self._stable((pair >> 1) // (self.size + 1), (pair >> 1) % (self.size + 1))
            held[miss] = (pair | good)[back]
            self.known_pairs[slot[miss]] = held[miss]
        return (held & 1).astype(bool)

    def _edges(self, code: np.ndarray, end_of: np.ndarray):
        """(start, piece) of every occurrence, from the suffix array of ``code``.

        ``end_of``: the place after the unit of each character; zeros (unknown
        characters, gaps between units) end every match.
        """
        n = len(code)
        padded = np.concatenate([code, np.zeros(self.longest + 2 * PACK, np.uint64)])
        word = np.zeros(n + self.longest + PACK, np.uint64)
        for k in range(PACK):
            word = (word << np.uint64(12)) | padded[k:k + len(word)]
        rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
        width = PACK
        while width < self.longest:
            ahead = np.concatenate([rank[width:], np.zeros(width, np.int64)])
            rank = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1]
            width *= 2
        suffixes = np.argsort(rank[:n], kind="stable")
        words = self.piece_low.shape[1]

        def bound(target: np.ndarray, after: bool) -> np.ndarray:
            low, high = np.zeros(len(target), np.int64), np.full(len(target), n, np.int64)
            while (open_ := low < high).any():
                mid = (low + high) // 2
                place = suffixes[np.minimum(mid, n - 1)]
                less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
                for w in range(words):
                    mine = word[place + w * PACK]
                    less |= same & (mine < target[:, w])
                    same &= mine == target[:, w]
                go = open_ & (less | (same if after else False))
                low = np.where(go, mid + 1, low)
                high = np.where(open_ & ~go, mid, high)
            return low

        first, last = bound(self.piece_low, False), bound(self.piece_high, True)
        count = np.maximum(last - first, 0)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = suffixes[np.repeat(first, count) + offset]
        return start, np.repeat(self.piece_ids, count)

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of units that hold a space symbol at most at their start."""
        joined = "\x00".join(units) + "\x00"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        found, back = np.unique(chars, return_inverse=True)
        code = np.array([self.code.get(chr(c), 0) if c else 0 for c in found.tolist()],
                        np.uint64)[back]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        unit = np.repeat(np.arange(len(units)), sizes + 1)
        start, piece = self._edges(code, begin[unit])
        gap = np.zeros(len(chars), bool)
        gap[begin + sizes] = True
        lone = np.flatnonzero((code == 0) & ~gap)  # unknown characters stand alone
        start = np.concatenate([start, lone])
        piece = np.concatenate([piece, np.full(len(lone), self.pad_id)])
        end = start + self.length[piece] - begin[unit[start]]
        order = np.argsort(end, kind="stable")
        start, piece, end = start[order], piece[order], end[order]
        cuts = np.flatnonzero(np.diff(end)) + 1
        last = np.full(len(chars) + 1, -1, np.int64)
        base = begin[unit]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(end)]):
            s, t = start[a:b], piece[a:b]
            inner = np.flatnonzero(s != base[s])
            good = np.ones(b - a, bool)
            good[inner] = self._stable_cached(last[s[inner] - 1], t[inner])
            s, t = s[good], t[good]
            last[s + self.length[t] - 1] = t
        place, who = begin + sizes, np.arange(len(units))
        got_unit, got_piece, got_place = [], [], []
        while True:
            live = place > begin[who]
            place, who = place[live], who[live]
            if not len(who):
                break
            t = last[place - 1]
            place = place - self.length[t]
            got_unit.append(who)
            got_piece.append(t)
            got_place.append(place)
        if not got_unit:
            return [b""] * len(units)
        u, t, p = map(np.concatenate, (got_unit, got_piece, got_place))
        order = np.argsort(p, kind="stable")
        u, t, p = u[order], t[order], p[order]
        stops = np.searchsorted(u, np.arange(len(units) + 1))
        raw = t.astype("<u4").tobytes()
        out = [raw[4 * a:4 * b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
        for k in np.unique(u[t == self.pad_id]).tolist():
            ids = []
            for x, at in zip(t[stops[k]:stops[k + 1]].tolist(), p[stops[k]:stops[k + 1]].tolist()):
                if x != self.pad_id:
                    ids.append(x)
                else:
                    char = chr(chars[at]).encode("utf-8", "surrogatepass")
                    ids += [self.byte_id.get(c, self.unknown) for c in char]
            out[k] = np.array(ids, "<u4").tobytes()
        return out

    def _run(self, n: int) -> bytes:
        """Ids of n space symbols: all their merges score alike, so the leftmost goes first."""
        runs, done = self.space_runs, []
        stack = [1] * min(n, 64)
        ahead = n - len(stack)
        while True:
            for i in range(len(stack) - 1):
                if stack[i] + stack[i + 1] in runs:
                    stack[i:i + 2] = [stack[i] + stack[i + 1]]
                    break
            else:
                if not ahead:
                    break
                done, stack = done + stack[:-2], stack[-2:]
            more = min(ahead, 64 - len(stack))
            stack += [1] * more
            ahead -= more
        return np.array([runs[x] for x in done + stack], "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit; null and empty: none."""
        if len(self.cache) > CACHE // 2:
            self.cache, self.older = {}, self.cache
        # A key is a unit without its space symbol, or, from a line end (of
        # which no piece is part) on, the characters up to the next border.
        split = [t.replace(SPACE, " ").replace("\x00", "\x00 ").replace("\n", " \n").split(" ")
                 if t and "\x00" not in t else [] for t in texts]
        used = set().union(*split)
        new = []
        for u in used:
            if u not in self.cache:
                if u in self.older:
                    self.cache[u] = self.older[u]
                else:
                    new.append(u)
        for at in range(0, len(new), UNITS):
            part = new[at:at + UNITS]
            self.cache.update(zip(part, self._encode_units(
                [u if u[:1] == "\n" else SPACE + u for u in part])))
        bare = np.uint32(self.id_of[SPACE]).tobytes()
        out = []
        for t, units in zip(texts, split):
            if not t:
                out.append(b"")
            elif "\x00" in t:  # the gap symbol of the index: piece by piece around it
                out.append(self._around_nulls(t))
            elif "" in units:
                out.append(self._with_runs(units, bare))
            else:
                out.append(b"".join(map(self.cache.__getitem__, units)))
        for u in new:
            if len(u) > LONG_UNIT:
                del self.cache[u]
        return out

    def _around_nulls(self, text: str) -> bytes:
        """Null characters are bytes of their own and part of no piece: the texts
        around them are encoded apart, all but the first without a space symbol."""
        first, *others = text.split("\x00")
        null = np.uint32(self.byte_id.get(0, self.unknown)).tobytes()
        out = [self.encode([first])[0] if first else np.uint32(self.id_of[SPACE]).tobytes()]
        for part in others:  # space symbol and line end in front are cut off
            out += [null, self.encode(["\n" + part])[0][8:] if part else b""]
        return b"".join(out)

    def _with_runs(self, units: list[str], bare: bytes) -> bytes:
        out, run = [], 0
        for u in units:
            if u == "":
                run += 1
                continue
            ids = self.cache[u]
            if run:
                if u[:1] != "\n" and ids[:4] == bare:
                    run, ids = run + 1, ids[4:]
                out.append(self._run(run))
                run = 0
            out.append(ids)
        if run:
            out.append(self._run(run))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces and bytes end to end, without the space put in
        front; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text; none for a null or empty text."""
    def run(batches):
        tok = PieceModel.of(model)
        for b in batches:
            yield {"doc_id": b["doc_id"],
                   "ids": [np.frombuffer(x, "<i4") for x in tok.encode(b["text"])]}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    def run(batches):
        tok = PieceModel.of(model)
        for b in batches:
            yield {"doc_id": b["doc_id"],
                   "text": [None if x is None else tok.decode(np.array(x, "<u4").tobytes())
                            for x in b["ids"]]}

    return arrow_map(rows.select(F.col("doc_id").cast("long"), "ids"), run,
                     "doc_id long, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, n_bytes, ids_crc32, round_trip) for every row of ``docs``.

    n_bytes: ids that stand for single bytes. ids_crc32: of the ids as
    little-endian unsigned 32-bit integers. round_trip: decoding gives the
    text back (with space symbols of the text as spaces; a null text counts as
    empty). Repeated rows repeat; an empty table gives no rows; other columns
    are not read.
    """
    def run(batches):
        tok = PieceModel.of(model)
        is_byte = np.zeros(len(tok.raw), bool)
        is_byte[list(tok.byte_id.values())] = True
        for b in batches:
            got = tok.encode(b["text"])
            yield {"doc_id": b["doc_id"], "n_tokens": [len(x) // 4 for x in got],
                   "n_bytes": [int(is_byte[np.frombuffer(x, "<u4")].sum()) for x in got],
                   "ids_crc32": [zlib.crc32(x) for x in got],
                   "round_trip": [tok.decode(x) == (t or "").replace(SPACE, " ")
                                  for x, t in zip(got, b["text"])]}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, n_tokens long, n_bytes long, ids_crc32 long, round_trip boolean")
