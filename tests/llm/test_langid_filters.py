"""Language filters against plain sets and counters."""

import random
from collections import Counter

import numpy as np
import pytest

from cardgrain.llm import langid
from cardgrain.llm.common import prepare

WORDS = {"xa": "ba be bi bo bu da de di do du", "xb": "ka ke ki ko ku ba be bi ta te",
         "xc": "su sa se si so na ne ni no nu"}


def texts(seed, n, words):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(words, k=3)) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def grams(text):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    low = " " + " ".join(low.split()) + " "
    return [low[i:i + n] for n in langid.ORDERS for i in range(len(low) - n + 1)]


def hashed(gram):
    h = np.full(1, len(gram), np.uint64)
    for c in gram:
        h = (h ^ np.uint64(ord(c))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


@pytest.fixture(scope="module")
def learned(spark):
    prepare(spark)
    train = [(t, lang) for i, (lang, w) in enumerate(WORDS.items()) for t in texts(i, 120, w.split())]
    df = spark.createDataFrame(train, "text string, lang string").repartition(3)
    return train, langid.learn(df)


def plain_sets(train, share):
    out = {}
    for lang in sorted({lang for _, lang in train}):
        # Texts are put together with line ends, which are spaces as well.
        counts = Counter(g for t, x in train if x == lang for g in grams(t))
        total, seen, least = sum(counts.values()), 0, 0
        for _, n in counts.most_common():
            if seen >= total * share:
                break
            least, seen = n, seen + n
        out[lang] = {g for g, n in counts.items() if n >= least}
    return out


def test_each_language_knows_its_share(learned):
    train, filters = learned
    for lang, i in zip(filters.languages, range(3)):
        own = [t for t, x in train if x == lang]
        covered = [np.count_nonzero(filters.masks(h)[:, 0] & filters.place(i)[1]) for t in own for h in langid.grams(t)]
        total = sum(len(h) for t in own for h in langid.grams(t))
        assert sum(covered) / total > 0.93


def test_masks_popcounts_and_correction_equal_plain_sets(learned):
    train, filters = learned
    known = plain_sets(train, langid.SHARE)
    assert filters.languages == sorted(known)
    missed = false = asked = 0
    for text in texts(9, 30, " ".join(WORDS.values()).split()) + ["zz qq xyz", "BA-be!"]:
        every = grams(text)
        masks = np.array([filters.masks(hashed(g))[0, 0] for g in every])
        counts, total = filters.hits(text, langid.ORDERS)
        assert total == len(every)
        want = []
        for i, lang in enumerate(filters.languages):
            bit = (masks >> i & 1).astype(bool)
            inside = np.array([g in known[lang] for g in every])
            missed += (inside & ~bit).sum()
            false, asked = false + (bit & ~inside).sum(), asked + (~inside).sum()
            assert counts[i] == bit.sum()
            want.append(max(0.0, (bit.mean() - filters.false_rate[i]) / (1 - filters.false_rate[i])))
        lang, score, coverage = filters.predict(text)
        if max(want) > 0:
            assert lang == filters.languages[int(np.argmax(want))]
            assert score == pytest.approx(max(want) / sum(want)) and coverage == pytest.approx(max(want))
    # n-grams across two texts of one batch are learned too; nothing a set holds is missed.
    assert missed == 0 and false / asked < 0.05


def test_a_script_of_many_letters_is_covered(spark):
    """Thousands of letters: few n-grams are frequent, and still most of a text is known."""
    prepare(spark)
    rng = random.Random(5)
    words = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2)) for _ in range(4000)]

    def text():
        return " ".join(words[int(rng.paretovariate(0.7)) % len(words)] for _ in range(200))
    train = [(text(), "zz") for _ in range(400)] + [(t, "xa") for t in texts(1, 200, WORDS["xa"].split())]
    filters = langid.learn(spark.createDataFrame(train, "text string, lang string"))
    got = [filters.predict(text()) for _ in range(20)]
    assert {g[0] for g in got} == {"zz"} and min(g[2] for g in got) > 0.6


@pytest.mark.parametrize("n", [1, 8, 9, 40, 70])
def test_words_hold_all_languages(n):
    filters = langid.Filters.empty([f"l{i:02d}" for i in range(n)], 4096)
    assert filters.slots.shape[1] * filters.slots.itemsize * 8 >= n
    for i in range(n):
        filters.add(i, hashed(f"gram{i}"))
    for i in range(n):
        word, bit = filters.place(i)
        assert filters.masks(hashed(f"gram{i}"))[0, word] & bit


def test_texts_are_joined_by_size(monkeypatch):
    monkeypatch.setattr(langid, "JOINED", 10)
    assert list(langid._joined(["a" * 12, "b", "c" * 9, "d"])) == ["a" * 12, "b\n" + "c" * 9, "d"]
