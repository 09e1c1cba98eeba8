"""Whole-text encoding with the tokenizers library, word by word from a cache.

Texts repeat their words, and both tokenizer kinds used here cut a text at
single spaces and line ends before they look any further, so the ids of a text
are the ids of such units end to end. A unit not seen before goes through the
library; the others come from a bounded per-worker cache. A text in which a
space or line end touches white space on both sides (where a cut could change
the units) goes through the library whole, and so does one with an added token.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 800_000  # units, about 160 MB; half of them of the older generation
LONG_UNIT = 2000  # longer units are not worth keeping
RUN_CHARS = 8_000_000  # characters encoded at once (or one longer text)
# Letters whose lower case is one letter and needs no context, then marks.
_LATIN = re.compile(
    "([A-Za-zÀ-ÖØ-öø-\u012f\u0131-ɏ]+)([.,;:!?*#$%&|)(-]*)").fullmatch
_DOUBTFUL = re.compile(r"(?:\s|^)[ \n](?:\s|$)").search
# Byte-level alphabet: printable bytes stand for themselves, the others for
# the code points from 256 on, in order.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _SELF} | {
    b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_SELF))}


class _Units(dict):
    """Ids of units; a missing one is taken from the older generation or encoded."""

    def __init__(self, encode, older: dict):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.encode(unit, self)
        if len(unit) <= LONG_UNIT:
            self[unit] = ids
        return ids


class WordEncoder:
    """Ids (little-endian unsigned 32-bit bytes) of whole texts for one tokenizer file."""

    _made: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        # A byte-level tokenizer keeps the space in front of a word; one that
        # drops white space sees the words alone, in lower case.
        # A text with an added token's content goes through the library whole.
        added = [re.escape(t["content"]) for t in kind.get("added_tokens") or [] if t["content"]]
        self.added = re.compile("|".join(added), re.IGNORECASE).search if added else lambda _: None
        self.keeps_space = kind["pre_tokenizer"]["type"] == "ByteLevel"
        self.line_end = self._library(["\n"])[0]
        self.tails: dict[str, bytes] = {}
        self.cache = _Units(self._unit, {})

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _piece(self, piece: str, lead: str = "") -> bytes:
        if not piece.isascii():
            piece = "".join([_BYTE[b] for b in piece.encode()])
        return array("I", [t.id for t in self.model.tokenize(lead + piece)]).tobytes()

    def _unit(self, unit: str, cache: dict) -> bytes:
        """Ids of one unit. A Latin word with marks after it goes to the library's
        model as the two pieces that its pre-tokenizer makes of it, any other
        unit through the whole library. Keys: see :meth:`_spaced`.
        """
        lead, front, body = "", b"", unit
        if self.keeps_space:
            if unit[:1] == "\n":
                front, body = self.line_end, unit[1:]
            elif unit[:1] == "\x00":
                body = unit[1:]
            else:
                lead = "Ġ"
        word = _LATIN(body)
        if not word:
            return self._library([unit if front else " " + unit if lead else body])[0]
        head, tail = word[1], word[2]
        if not self.keeps_space:
            head = head.lower()
        if not tail:
            return front + self._piece(head, lead)
        if tail not in self.tails:
            self.tails[tail] = self._piece(tail)
        ids = self._piece(head) if self.keeps_space and not lead else cache[head]
        return front + ids + self.tails[tail]

    def _spaced(self, text: str) -> str:
        """Cache keys of a text's units, with a space between: from the line end on,
        else without the space in front (the first unit, which has none, is marked)."""
        if self.keeps_space:
            return ("\x00" + text).replace("\n", " \n")
        try:
            text.encode("latin-1")
            text = text.lower()  # needs no context and no composition here
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text; null counts as empty."""
        out = [b""] * len(texts)
        held, size = [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.added(t) or self.keeps_space and ("\x00" in t or _DOUBTFUL(t)):
                out[i] = self._library([t])[0]
                continue
            held.append(i)
            size += len(t)
            if size >= RUN_CHARS:
                self._encode_run(texts, held, out)
                held, size = [], 0
        if held:
            self._encode_run(texts, held, out)
        return out

    def _encode_run(self, texts: list, at: list[int], out: list[bytes]) -> None:
        """Ids of the texts numbered ``at`` into ``out``: each distinct unit of the
        run is looked up once, and the texts are put together from those ids."""
        if len(self.cache) > CACHE // 2:
            self.cache = _Units(self._unit, dict(self.cache))
        units = pc.split_pattern(pa.array([self._spaced(texts[i]) for i in at],
                                          pa.large_string()), " ")
        coded = units.values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.cache.__getitem__, distinct))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = pa.LargeListArray.from_arrays(
            np.concatenate([[0], np.cumsum(sizes)]),
            pa.array(np.frombuffer(b"".join(known), "<u4"))).take(coded.indices)
        raw = memoryview(ids.values.to_numpy()).cast("B")
        ends = (4 * ids.offsets.to_numpy()[units.offsets.to_numpy()]).tolist()
        for k, i in enumerate(at):
            out[i] = bytes(raw[ends[k]:ends[k + 1]])
