"""Language identification with bit-sliced Bloom filters of character n-grams.

Each language has a Bloom filter of its most frequent n-grams, as many as make up
``share`` of the n-grams of its training text: every language knows that share
of its own text, whatever its script and the size of the corpus. The filters
are stored bit-sliced: slot i holds one bit for every language. A lookup ANDs the slots of an n-gram's
hashes and returns all languages that contain it at once. A text's hits are
counted per language (a population count over its n-grams), corrected for
each filter's false-positive rate, and the highest corrected share decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map, materialize

ORDERS = (3, 4)
SHARE = 0.95
JOINED = 1 << 20  # characters of texts that are hashed together
HASHES = 3
SLOTS_PER_GRAM = 16
BLOCK_CHARS = 1 << 20


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, letters kept and each run of anything
    else turned into one space, with a space at both ends; empty without a letter."""
    low = text.lower()
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.unique(code)
    letter = np.array([chr(c).isalpha() for c in found.tolist()], bool)
    if not letter.any():
        return np.zeros(0, np.uint32)
    if found[-1] < 0x10000:
        table = np.zeros(0x10000, bool)
        table[found[letter]] = True
        keep = table[code]
    else:
        keep = letter[np.searchsorted(found, code)]
    code = np.where(keep, code, np.uint32(32))
    code = np.concatenate([[np.uint32(32)], code, [np.uint32(32)]])
    space = code == 32
    return code[np.concatenate([[True], ~(space[1:] & space[:-1])])]


def grams(text: str | None, orders=ORDERS):
    """64-bit hashes of the character n-grams of a whole text, in blocks."""
    code = _codes(text) if text else np.zeros(0, np.uint32)
    for at in range(0, len(code), BLOCK_CHARS):
        part = code[at:at + BLOCK_CHARS + max(orders) - 1].astype(np.uint64)
        last = at + BLOCK_CHARS >= len(code)
        for n in orders:
            size = len(part) - n + 1 if last else BLOCK_CHARS
            if size <= 0:
                continue
            h = np.full(size, n, np.uint64)
            for j in range(n):
                h = (h ^ part[j:j + size]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            yield h


@dataclass
class Filters:
    """Bit-sliced filters: ``slots`` (slots x words, a bit for each language), the languages
    in order, and every language's false-positive rate."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    prior: int

    @classmethod
    def empty(cls, languages: list[str], size: int) -> Filters:
        """Words of 8, 16, 32 or 64 languages, the fewest bytes that hold all."""
        bits = next((b for b in (8, 16, 32) if len(languages) <= b), 64)
        words = -(-max(1, len(languages)) // bits)
        return cls(languages, np.zeros((size, words), f"uint{bits}"), np.zeros(len(languages)), 0)

    def place(self, language: int):
        """(word, mask) of a language's bit."""
        bits = 8 * self.slots.itemsize
        return language // bits, self.slots.dtype.type(1 << (language % bits))

    def _at(self, h: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.slots))
        step = (h >> np.uint64(33)) | np.uint64(1)
        return [((h + np.uint64(k) * step) % size).astype(np.int64) for k in range(HASHES)]

    def add(self, language: int, h: np.ndarray) -> None:
        word, bit = self.place(language)
        for at in self._at(h):
            self.slots[at, word] |= bit

    def masks(self, h: np.ndarray) -> np.ndarray:
        """Bit mask of the languages that contain each n-gram."""
        first, *rest = self._at(h)
        out = self.slots[first]
        for at in rest:
            out &= self.slots[at]
        return out

    def hits(self, text: str | None, orders) -> tuple[np.ndarray, int]:
        counts, total = np.zeros(len(self.languages)), 0
        for h in grams(text, orders):
            m = self.masks(h)
            total += len(h)
            for lang in range(len(self.languages)):
                word, bit = self.place(lang)
                counts[lang] += np.count_nonzero(m[:, word] & bit)
        return counts, total

    def predict(self, text: str | None, orders=ORDERS) -> tuple[str, float, float]:
        """(language, score, coverage); score: the language's part of all corrected
        hits, coverage: its corrected share of the text's n-grams."""
        counts, total = self.hits(text, orders)
        if not total:
            return "und", 0.0, 0.0
        if not self.languages:
            return "und", 0.0, 0.0
        share = np.clip((counts / total - self.false_rate) / (1 - self.false_rate), 0.0, 1.0)
        if not share.any():
            return self.languages[self.prior], 0.0, 0.0
        best = int(np.argmax(share))
        return self.languages[best], float(share[best] / share.sum()), float(share[best])


def _joined(texts: list[str]):
    """Texts put together, up to about ``JOINED`` characters at once."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= JOINED:
            yield "\n".join(held)
            held, size = [], 0
    if held:
        yield "\n".join(held)


def learn(docs: DataFrame, orders=ORDERS, share: float = SHARE) -> Filters:
    """Filters from all rows of ``docs`` (text, lang) with a text and a lang.

    N-grams are counted over whole texts: first in every task, then by
    (language, n-gram). Each language's least count is the one from which on its
    n-grams make up ``share`` of all; it is found from the numbers of n-grams
    by count. The n-grams kept come to the driver and make up the filters:
    they grow with the n-grams that cover a language, not with its texts.
    """
    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                h, c = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(c, np.concatenate([p[1] for p in parts])).astype(np.int64)
                for i in range(0, len(h), 200_000):
                    yield {"lang": [lang] * len(h[i:i + 200_000]),
                           "h": h[i:i + 200_000].view(np.int64), "n": n[i:i + 200_000]}

        for b in batches:
            joined: dict[str, list[str]] = {}
            for text, lang in zip(b["text"], b["lang"]):
                joined.setdefault(lang, []).append(text)
            for lang, texts in joined.items():
                for t in _joined(texts):
                    for h in grams(t, orders):
                        u, n = np.unique(h, return_counts=True)
                        held.setdefault(lang, []).append((u, n))
                        size += len(u)
            if size > 4_000_000:
                for lang, parts in held.items():
                    h, c = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    held[lang] = [(h, np.bincount(c, np.concatenate(
                        [p[1] for p in parts])).astype(np.int64))]
                size = sum(len(p[0]) for parts in held.values() for p in parts)
                if size > 2_000_000:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    counts = arrow_map(rows, count, "lang string, h long, n long").groupBy("lang", "h").agg(
        F.sum("n").alias("n"))
    counts = materialize(counts, "grams")
    # A row per language and distinct count: far fewer than n-grams, as counts repeat.
    by_count = counts.groupBy("lang", "n").agg((F.col("n") * F.count("*")).alias("tokens"))
    falling = Window.partitionBy("lang").orderBy(F.desc("n"))
    least = (by_count.withColumn("before", F.sum("tokens").over(falling) - F.col("tokens"))
             .withColumn("total", F.sum("tokens").over(Window.partitionBy("lang")))
             .where(F.col("before") < F.col("total") * share)
             .groupBy("lang").agg(F.min("n").alias("least"), F.first("total").alias("total")))
    kept = counts.join(F.broadcast(least), "lang").where(  # a row per language
        F.col("n") >= F.col("least")).select("lang", "h", "total").toArrow()
    langs = sorted(set(kept["lang"].to_pylist()))
    h = kept["h"].to_numpy().view(np.uint64)
    lang = np.array(kept["lang"].to_pylist(), object)
    total = kept["total"].to_numpy()
    most = max([int((lang == x).sum()) for x in langs], default=1)
    slots = max(1024, SLOTS_PER_GRAM * most)
    out = Filters.empty(langs, slots)
    for i, name in enumerate(langs):
        out.add(i, h[lang == name])
    for i in range(len(langs)):
        word, bit = out.place(i)
        fill = np.count_nonzero(out.slots[:, word] & bit) / slots
        out.false_rate[i] = fill ** HASHES
    if langs:
        out.prior = int(np.argmax([total[lang == x].max() for x in langs]))
    return out


def identify(docs: DataFrame, filters: Filters, orders=ORDERS) -> DataFrame:
    """(doc_id, lang_pred, score, coverage) for every row of ``docs`` (doc_id, text).

    ``und`` with score 0 for a null text or one without a letter (or if nothing
    was learned); a text none of whose n-grams is known gets the language with
    most training text, score 0. Ties go to the first language by name.
    Repeated rows repeat; an empty table gives no rows; other columns are not
    read.
    """
    def run(batches):
        for b in batches:
            got = [filters.predict(t, orders) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "lang_pred": [g[0] for g in got],
                   "score": [g[1] for g in got], "coverage": [g[2] for g in got]}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, lang_pred string, score double, coverage double")


def keep(docs: DataFrame, filters: Filters, least_coverage: float, orders=ORDERS) -> DataFrame:
    """The rows of ``docs`` whose predicted language is not ``und`` and knows at
    least ``least_coverage`` of the text's n-grams, columns as they are."""
    def run(batches):
        for b in batches:
            got = [filters.predict(t, orders)
                   for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield b.filter(pa.array([g[0] != "und" and g[2] >= least_coverage for g in got],
                                    pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
