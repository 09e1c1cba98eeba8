"""The n-gram trie against plain counts: n-grams seen once, files cut in many ways, large counts."""

from collections import Counter

import numpy as np
import pytest

from cardgrain.llm import ngrams
from cardgrain.llm.common import prepare

TEXTS = ["a b c a b d", "a b c", "b c a b", None, "", "a b", "the rare words come once", "a a a a a a a a a b a",
         "x " * 40, "rare words", "B A\tc"]


def plain(texts, order, add=0.1, discount=0.5):
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        t = (t or "").lower().split() + ["</s>"]
        for n in range(1, order + 1):
            grams[n].update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
    total, distinct = sum(grams[1].values()), len(grams[1])

    def p(context, w):
        out = (grams[1].get((w,), 0) + add) / (total + add * (distinct + 1))
        for n in range(2, order + 1):
            c = tuple(context[len(context) - n + 1:])
            if len(context) < n - 1 or not grams[n - 1][c] or c[-1] == "</s>":
                break
            kept = {g[-1]: k for g, k in grams[n].items() if g[:-1] == c}
            out = max(kept.get(w, 0) - discount, 0) / grams[n - 1][c] + (
                1 - sum(k - discount for k in kept.values()) / grams[n - 1][c]) * out
        return out
    return p, grams


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("shard", [2_000_000, 9, 3])
def test_scores_with_ngrams_seen_once(spark, order, shard):
    prepare(spark)
    train = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    model = ngrams.learn(train, order=order, shard_tokens=shard)
    p, grams = plain(TEXTS, order)
    assert min(grams[order].values()) == 1
    for n in range(2, order + 1):
        assert model.levels[n - 1].size == len(grams[n])
    tests = [*TEXTS, "rare words come twice", "zz a b zz", "c a b d a b c x x x once"]
    for r in ngrams.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect():
        t = (tests[r["doc_id"]] or "").lower().split() + ["</s>"]
        want = sum(np.log10(p(t[:i], w)) for i, w in enumerate(t))
        assert r["score"] == pytest.approx(want, abs=1e-4 * order * len(t))


def test_counts_of_over_32_bits():
    counts = np.array([1, 254, 255, 256, 6_000_000_000, 2 ** 40, 3], np.int64)
    f = ngrams.Counts(memoryview(ngrams._counts(counts)), 0)
    assert f.of(np.array([0, 1, 2, 3, 4, 5, 6, -1])).tolist() == [*counts.tolist(), 0]
    parent, child = np.array([5, 5, 7], np.uint64), np.array([0, 9, 4], np.uint64)
    total = np.array([6_000_000_000, 1, 2 ** 33], np.int64)
    p, distinct, used, of = ngrams._discounted(parent, total, {7: 2 ** 34})
    assert of.tolist() == [6_000_000_001, 2 ** 34] and p.max() <= 1 and (used <= of).all()
    g = ngrams.GramFile(memoryview(ngrams.GramFile.build(4, 9, 4, parent, child, p, np.ones(5), total)))
    _, got, count, at = g.look(np.array([5, 6, 7], np.uint64), np.array([2, 1, 1]), np.array([0, 9, 4, 4], np.uint64))
    assert count.tolist() == [6_000_000_000, 1, 0, 2 ** 33] and at.tolist() == [0, 1, -1, 2]
    assert got[0] == pytest.approx(1.0) and got[3] == pytest.approx(0.5, abs=1e-3) and got[2] == 0
    assert g.followers(5).tolist() == [0, 9] and g.followers(6).tolist() == []


def test_blobs_keep_entries():
    rng = np.random.default_rng(1)
    parent = np.sort(rng.integers(0, 2 ** 40, 500).astype(np.uint64).repeat(2))
    child, count = rng.integers(0, 2 ** 30, 1000).astype(np.uint64), rng.integers(1, 2 ** 35, 1000)
    for got, want in zip(ngrams._unblob(ngrams._blob(parent, child, count)), (parent, child, count)):
        assert (got == want).all()


def test_keys_too_wide_for_one_word_are_sorted_by_both():
    parent = np.array([2 ** 60, 3, 2 ** 60, 3], np.uint64)
    child = np.array([1, 2, 0, 1], np.uint64)
    assert ngrams._order(parent, child, 20).tolist() == [3, 1, 2, 0]


def test_files_not_mapped_are_let_go(spark, monkeypatch):
    prepare(spark)
    model = ngrams.learn(spark.createDataFrame([(t,) for t in TEXTS], "text string"), shard_tokens=3)
    real = ngrams.read_file
    monkeypatch.setattr(ngrams, "read_file", lambda uri: memoryview(bytes(real(uri))))
    monkeypatch.setattr(ngrams, "HELD", 1)
    import pyarrow as pa
    found = [c.tolist() for *_, c, _ in model.grams(ngrams.tokens(pa.array(["a b c", "rare words"])), 3)]
    assert found[2] == [0, 0, 1, 1, 0, 0, 1] and len(model.__dict__["_open"]) == 1
