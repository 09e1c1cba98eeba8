"""The training-data operators on small tables: brute force, round trips, held-out
accuracy, and nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardgrain.llm import (eliasfano, langid, ngrams, nndescent, packing, piecetok, quality,
                           registry, simhash, sketch, urlfilter, wavelet)
from cardgrain.llm.common import prepare
from cardgrain.llm.graph import connected_components
from cardgrain.llm.wordcache import WordEncoder

SF = "/root/testdata/sf0.001"
# Extra columns whose names operators use inside.
SCHEMA = ("doc_id long, text string, fp long, ids string, block int, score double, part int, "
          "component_id string, guest boolean")
TEXTS = ["", " ", None, "one", "one two", "a b c", "A B C", "the quick brown fox jumps", "x " * 30000,
         "the quick brown fox jumps", "l'été à l'école?  2024\n\nok", "\x00 nul", "🙂 ünï", "  lead"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (3, "one")]
    return spark.createDataFrame([(i, t, 1, "x", 2, 0.5, 3, "y", True) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def key(row):
    return tuple((x is not None, str(x)) for x in row)


# -- components -------------------------------------------------------------

def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r[0]: r[1] for r in connected_components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}}


# -- SimHash ----------------------------------------------------------------

def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_simhash_operator(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    comp = components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for r, p in zip(rows, prints):
        if r["doc_id"] is not None:
            low[comp[p]] = min(low.get(comp[p], r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{p:016x}", low.get(comp[p])) for r, p in zip(rows, prints)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot", [10_000, 3])
def test_pigeonring_links_are_complete(spark, hot):
    """All pairs within 3 bits, or with the route for large buckets the same components."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.near_pairs(df, hot_bucket=hot).collect()}
    mask = (1 << 64) - 1
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}
    if hot > 100:
        assert got == near
    else:
        assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in got)
    linked = got | {(b, a) for a, b in got}
    full = near | {(b, a) for a, b in near}
    nodes = sorted(signed)
    assert components(nodes, lambda a, b: (a, b) in linked) == components(
        nodes, lambda a, b: (a, b) in full)


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    parts = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert ids == sorted(d for d, c in parts.items() if d is not None and d == c)
    assert kept.where("doc_id is null").count() == 2


# -- quality ----------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    got = registry.op2_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert np.mean([r[0] == r[1] for r in rows]) > 0.93
    assert got.where("score < 0 or score > 1 or predicted <> if(score >= 0.5, 1, 0)").count() == 0


def test_quality_edges(spark, docs, empty):
    vectors = quality.word_vectors(docs)
    labels = spark.createDataFrame([(0, 1), (5, 0), (None, 1), (7, None), (5, 0)],
                                   "doc_id long, label int")
    net = quality.learn(docs, labels, vectors)
    assert quality.classify(docs, vectors, net).count() == docs.count()
    assert quality.classify(empty, vectors, net).count() == 0
    assert not quality.word_vectors(empty).any() or quality.word_vectors(empty).shape[1] == quality.DIM
    none = quality.learn(docs, labels.where("false"), vectors)
    assert none.score(np.zeros((1, quality.WIDTH)))[0] == pytest.approx(0.5)
    assert quality.keep(docs, vectors, none, 0.0).columns == docs.columns


def test_word_vectors_match_plain_counts(spark):
    text = "a b c a b\nzz yy"
    df = spark.createDataFrame([(text,), ("a b",), (None,)], "text string")
    places, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for t in (text, "a b"):
        b = quality.buckets(t)
        for i in range(len(b)):
            for j in range(max(0, i - 2), min(len(b), i + 3)):
                if i != j:
                    for p, s in zip(places[b[j]], signs[b[j]]):
                        want[b[i], p] += s
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1)
    for w in range(quality.BUCKETS):
        for p, s in zip(places[w], signs[w]):
            want[w, p] += quality.OWN * s
    assert np.allclose(quality.word_vectors(df), want, atol=1e-5)


# -- language ---------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    got = registry.op3_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


def test_language_edges(spark, docs, empty):
    train = spark.createDataFrame([("hello there world", "en"), ("bonjour le monde", "fr"),
                                   (None, "de"), ("wer", None)], "text string, lang string")
    filters = langid.learn(train)
    assert filters.languages == ["en", "fr"]
    rows = langid.identify(docs, filters).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == docs.count() and by[0]["lang_pred"] == by[2]["lang_pred"] == "und"
    assert langid.identify(spark.createDataFrame([(1, "hello world"), (2, "le monde"), (3, "12 !?")],
                           "doc_id long, text string"), filters).select("lang_pred").toPandas()[
        "lang_pred"].tolist() == ["en", "fr", "und"]
    assert langid.identify(empty, filters).count() == 0
    assert langid.learn(train.where("false")).languages == []
    nothing = langid.learn(train.where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_blocked_ngrams_equal_whole(monkeypatch):
    text = "The quick brown fox, " * 50
    whole = np.sort(np.concatenate(list(langid.grams(text))))
    monkeypatch.setattr(langid, "BLOCK_CHARS", 7)
    assert (np.sort(np.concatenate(list(langid.grams(text)))) == whole).all()


# -- n-gram model -----------------------------------------------------------

def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, universe in ((0, 10), (1, 1 << 63), (1000, 5000), (5000, 1 << 62), (3, 3)):
        v = np.unique(rng.integers(0, universe, n).astype(np.uint64))
        f = eliasfano.EliasFano(memoryview(eliasfano.build(v, universe)))
        assert (f.access(np.arange(len(v))) == v).all()
        q = np.sort(np.concatenate([v, rng.integers(0, universe, 200).astype(np.uint64)]))
        at = f.find(q)
        want = {int(x): i for i, x in enumerate(v)}
        assert at.tolist() == [want.get(int(x), -1) for x in q]


@pytest.mark.parametrize("shard", [2_000_000, 7])
def test_ngram_scores_match_plain_model(spark, docs, empty, shard):
    train = spark.createDataFrame([(t,) for t in ["a b c a b d", "a b c", "b c a b", None, "", "a b"] * 2],
                                  "text string")
    model = ngrams.learn(train, order=3, shard_tokens=shard)
    uni, bi, tri = Counter(), Counter(), Counter()
    for r in train.collect():
        t = (r[0] or "").split() + ["</s>"]
        uni.update(t)
        bi.update(zip(t, t[1:]))
        tri.update(zip(t, t[1:], t[2:]))
    bi = {g: c for g, c in bi.items() if c >= 2}
    tri = {g: c for g, c in tri.items() if c >= 2 and g[:2] in bi and g[1:] in bi}
    n, v = sum(uni.values()), len(uni)
    assert (model.total, model.distinct) == (n, v)

    def p(context, w):
        out = (uni.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))
        for k, grams in ((1, bi), (2, tri)):
            c = tuple(context[-k:])
            if len(context) < k or (k == 2 and c not in bi) or (k == 1 and not uni[c[0]]):
                continue
            total = uni[c[0]] if k == 1 else bi[c]
            kept = {g[-1]: x for g, x in grams.items() if g[:-1] == c}
            out = max(kept.get(w, 0) - 0.5, 0) / total + (
                1 - sum(x - 0.5 for x in kept.values()) / total) * out
        return out

    for context in (["a"], ["a", "b"], ["b", "c"], ["zz"], []):
        assert sum(p(context, w) for w in [*uni, "unseen"]) == pytest.approx(1)
    tests = spark.createDataFrame([(1, "a b c a b d"), (2, "c c zz a"), (3, None), (None, "a b")],
                                  "doc_id long, text string")
    for r in ngrams.score(tests, model).collect():
        t = {1: "a b c a b d", 2: "c c zz a", 3: "", None: "a b"}[r["doc_id"]].split() + ["</s>"]
        want = sum(np.log10(p(t[max(0, i - 2):i], w)) for i, w in enumerate(t))
        assert r["score"] == pytest.approx(want, abs=2e-3)
        assert r["base_score"] == pytest.approx(sum(
            np.log10((uni.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(w in uni for w in t))
    assert ngrams.score(docs, model).count() == docs.count()
    assert ngrams.score(empty, model).count() == 0
    nothing = ngrams.learn(train.where("false"))
    assert {r["score"] for r in ngrams.score(tests, nothing).collect()} == {0.0}


# -- packing and encoding ---------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoding_equals_the_library(name):
    rng = random.Random(2)
    texts = [t for t in TEXTS] + ["it's  We'll\tgo\r\n", "Word.\nNext, line", "İ Σς ΑΣ", "a\n b \n c"]
    texts += ["".join(rng.choice(" \n\tab'sé 　\x1c1!<|Σ") for _ in range(rng.randint(0, 14)))
              for _ in range(800)]
    enc = WordEncoder(registry.tokenizer_path(name))
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(
        [t or "" for t in texts], add_special_tokens=False)]
    assert enc.encode(texts) == want == enc.encode(texts)


def check_packing(rows, docs, capacity):
    enc = WordEncoder.of(registry.tokenizer_path("byte_bpe_50k.json"))
    wanted = defaultdict(int)
    for r in docs.select("doc_id", "text").collect():
        wanted[r["doc_id"], enc.encode([r["text"]])[0] + np.uint32(1).tobytes()] += 1
    sequences, pieces = defaultdict(list), defaultdict(int)
    by_doc = defaultdict(set)
    for (d, ids) in wanted:
        by_doc[d].add(ids)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(zlib.crc32(x[4 * r["start"]:4 * (r["start"] + r["length"])]) == r["ids_crc32"]
                   and len(x) // 4 == r["doc_tokens"] for x in by_doc[r["doc_id"]])
        pieces[r["doc_id"]] += r["length"]
    for d, total in pieces.items():
        assert total == sum(len(x) // 4 * n for (e, x), n in wanted.items() if e == d)
    assert set(pieces) == set(by_doc)
    padding = used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        used += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(1, used)


def test_packing(spark, docs, empty):
    path = registry.tokenizer_path("byte_bpe_50k.json")
    check_packing(packing.pack(docs, path, 1).collect(), docs, 2048)
    sample = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    assert check_packing(packing.pack(sample, path, 1).collect(), sample, 2048) < 0.03
    assert packing.pack(empty, path, 1).count() == 0


# -- fingerprints -----------------------------------------------------------

def test_edited_fingerprints(spark, docs, empty):
    got = sketch.edited_fingerprints(docs.where("doc_id is not null")).collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.where(
        "doc_id is not null").select("doc_id", "text").collect()), key=lambda r: (-r[0], r[1]))
    want = []
    for i, (d, t) in enumerate(rows):
        nxt, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(want)
    by = {r["doc_id"]: r for r in got}
    assert by[7]["fingerprint"] == by[9]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert sketch.edited_fingerprints(docs).count() == docs.count()
    assert sketch.edited_fingerprints(docs.where("doc_id is null")).count() == 2
    assert sketch.edited_fingerprints(empty).count() == 0


def test_next_document_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(sketch, "BLOCK_DOCS", 4)
    ids = random.Random(3).sample(range(-10**12, 10**12), 97)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in sketch.with_next(df).collect()}
    down = sorted(ids, reverse=True)
    assert got == {d: f"t{down[(i + 1) % len(down)]}" for i, d in enumerate(down)}


def test_sketch_estimates(spark):
    def text(a, b):
        return " ".join(f"w{i}" for i in range(a, b))
    df = spark.createDataFrame([(text(0, 4000), text(1000, 5000), text(0, 400))], "a string, b string, c string")
    s = {c: sketch.sketch(F.col(c)) for c in "abc"}
    r = df.select(sketch.resemblance(s["a"], s["b"]).alias("ab"),
                  sketch.containment(s["c"], s["a"]).alias("ca"),
                  sketch.distinct_count(s["a"]).alias("n"),
                  sketch.distinct_count(sketch.merge(s["a"], s["b"])).alias("u")).first()
    assert abs(r["ab"] - 0.6) < 0.15 and r["ca"] > 0.6
    assert abs(r["n"] / 3996 - 1) < 0.3 and abs(r["u"] / 4996 - 1) < 0.3
    parts = spark.createDataFrame([("k", text(0, 300)), ("k", text(200, 600)), ("j", "a b c d e f")],
                                  "key string, t string").withColumn("s", sketch.sketch(F.col("t")))
    merged = {x["key"]: x["sketch"] for x in sketch.merged_sketches(parts, "key", "s").collect()}
    one = parts.where("key = 'k'").agg(F.sort_array(F.array_distinct(
        F.flatten(F.collect_list("s")))).alias("s")).first()["s"][:sketch.K]
    assert merged["k"] == one and len(merged["j"]) == 2


# -- token files ------------------------------------------------------------

def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (0, 1, 70_000):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
        w = wavelet.WaveletMatrix(wavelet.build(ids, np.array([4, 9]), np.array([0, n])))
        assert (w.decode() == ids).all() and w.doc_ids.tolist() == [4, 9]
        for t in (1, 2, 77, 60_000):
            at = np.flatnonzero(ids == t)
            assert w.count(t) == len(at)
            assert [w.occurrence(t, j) for j in range(min(3, len(at)))] == at[:3].tolist()
        if n:
            assert [w.access(i) for i in (0, n // 2, n - 1)] == ids[[0, n // 2, n - 1]].tolist()
            assert w.count(1, n // 3, n // 2) == (ids[n // 3:n // 2] == 1).sum()


def test_token_files(docs, empty):
    path = registry.tokenizer_path("word_bpe_49k.json")
    manifest = wavelet.write_shards(docs, path, 2, shard_tokens=50)
    enc, end = WordEncoder.of(path), np.uint32(2).tobytes()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = Counter((r[0], enc.encode([r[1]])[0] + end) for r in rows)
    got = wavelet.read_documents(manifest).collect()
    assert Counter((r["doc_id"], np.array(r["ids"], "<u4").tobytes()) for r in got) == ids
    digests = sorted(wavelet.read_digests(manifest).collect(), key=lambda r: r["start"])
    at = 0
    for r in digests:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in digests] == [r["doc_id"] for r in rows]
    some = np.frombuffer(enc.encode(["one"])[0], "<u4")[0]
    places = wavelet.occurrences(manifest, int(some)).collect()
    assert len(places) == sum(n * int((np.frombuffer(x, "<u4") == some).sum()) for (_, x), n in ids.items())
    assert wavelet.read_digests(wavelet.write_shards(empty, path, 2)).count() == 0


def test_ngrams_seen_once_are_stored(spark):
    import pyarrow as pa

    docs = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, None)], "doc_id long, text string")
    model = ngrams.learn(docs)
    t = ngrams.tokens(pa.array(["b c a", "a b c"]))
    counts = {n: c.tolist() for n, _, _, c, _ in model.grams(t, 3)}
    assert counts[2] == [0, 1, 0, 0, 0, 2, 1, 1]
    assert counts[3] == [0, 0, 0, 0, 0, 0, 1, 1]


# -- vectors ----------------------------------------------------------------

def test_vector_links_match_brute_force(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 16))
    rows = [(i, [float(x) for x in base[i]], i % 2) for i in range(60)]
    for i in range(60, 160):  # near copies, a dense cluster among them
        k = 0 if i < 110 else int(rng.integers(0, 60))
        rows.append((i, [float(x) for x in base[k] + rng.normal(size=16) * 0.15], k % 2))
    rows += [(200, rows[5][1], rows[5][2]), (201, rows[5][1], rows[5][2]), (202, rows[5][1], None),
             (203, None, 1), (204, [0.0] * 16, 1), (205, [float("nan")] * 16, 1),
             (206, [1.0, None], 1), (207, [2.0], 1), (207, [2.0], 1), (208, [3.0], 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows] + [(None, rows[5][1], 1, 1, "x")],
                               "vec_id long, embedding array<float>, label int, nid int, root string")
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(df).collect()}
    good = {i: (np.array(e, np.float32).astype(np.float64), l) for i, e, l in rows
            if e and None not in e and l is not None and np.isfinite(e).all() and any(e)}

    def linked(a, b):
        (x, l), (y, m) = good[a], good[b]
        return l == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93
    comp = components(sorted(good), linked)
    for i in got:
        if i in good:
            assert got[i]["n_links"] == sum(linked(i, j) for j in good if j != i)
            assert got[i]["component_id"] == comp[i] and got[i]["kept"] == (comp[i] == i)
        elif i is not None:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["n_links"] == 0 and got[None]["component_id"] is None
    assert nndescent.near_duplicates(df.where("false")).count() == 0


def brute_links(e, threshold=0.93):
    e = e.astype(np.float32).astype(np.float64)
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    near = e @ e.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_vector_links_beside_a_dense_group(spark):
    """Missed pairs outside a dense group are seen by the audit; when the passes
    run out all nodes are compared."""
    rng = np.random.default_rng(3)
    group = rng.normal(size=32) + rng.normal(size=(500, 32)) * 0.05
    one = rng.normal(size=(400, 32))
    e = np.concatenate([group, one, one + rng.normal(size=one.shape) * 0.3])
    near = brute_links(e)
    df = spark.createDataFrame([(i, [float(x) for x in v], "a") for i, v in enumerate(e)],
                               "vec_id long, embedding array<float>, label string")
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(
        df, trees=1, rounds=0, max_passes=1).collect()}
    assert near[500:].any() and [got[i]["n_links"] for i in range(len(e))] == near.sum(1).tolist()
    comp = components(list(range(len(e))), lambda i, j: near[i, j])
    assert all(got[i]["component_id"] == comp[i] for i in comp)


def test_vector_audit_goes_on_until_it_sees_links(spark, monkeypatch):
    """One link that no tree finds, in far more nodes than a sample has."""
    monkeypatch.setattr(nndescent, "AUDIT", 8)
    rng = np.random.default_rng(4)
    e = rng.normal(size=(600, 32))
    e[599] = e[0] + rng.normal(size=32) * 0.3
    near = brute_links(e)
    assert near.sum() == 2
    df = spark.createDataFrame([(i, [float(x) for x in v], "a") for i, v in enumerate(e)],
                               "vec_id long, embedding array<float>, label string")
    nothing = lambda *_: spark.createDataFrame([], "a long, b long, sim double")
    monkeypatch.setattr(nndescent, "_join_groups", nothing)
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(
        df, trees=1, rounds=0, max_passes=1).collect()}
    assert [got[i]["n_links"] for i in range(len(e))] == near.sum(1).tolist()
    assert got[599]["component_id"] == 0


# -- urls -------------------------------------------------------------------

@pytest.mark.parametrize("limit", [200_000, 0])
def test_url_rules(spark, limit):
    urls = {1: None, 2: "", 3: "no scheme", 4: "http://a.NET", 5: "http://a.net/x?y#z", 6: "x://org/fr/",
            7: "https://www.Example.net/en/1", 8: "https://example.com/de/?q", 9: "https://notexample.com/de/",
            10: "http://net/", 11: "http://b.example.org/fr/a#b", 12: "http://a://b.net/c"}
    df = spark.createDataFrame([(k, u, "h", "p") for k, u in urls.items()],
                               "page_id long, url string, host string, rule string")
    got = {r["page_id"]: tuple(r)[1:] for r in urlfilter.judge(
        df, urlfilter.rule_table(spark), broadcast_rules=limit).collect()}
    assert got == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("a.net", "", None, "allow"), 5: ("a.net", "/x", "net/", "block"),
        6: ("org", "/fr/", "org/fr/", "allow"), 7: ("www.example.net", "/en/1", "example.net/en/", "allow"),
        8: ("example.com", "/de/", "example.com/de/", "block"), 9: ("notexample.com", "/de/", None, "allow"),
        10: ("net", "/", "net/", "block"), 11: ("b.example.org", "/fr/a", "org/fr/", "allow"),
        12: ("a:", "//b.net/c", None, "allow")}
    assert urlfilter.judge(df.where("false"), urlfilter.rule_table(spark)).count() == 0
    none = urlfilter.judge(df, urlfilter.rule_table(spark).where("false"))
    assert none.where("rule is null and verdict = 'allow'").count() == len(urls)


# -- pieces -----------------------------------------------------------------

def test_pieces_equal_the_library(spark, docs, empty):
    import sentencepiece

    path = registry.tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    texts = list(TEXTS) + ["a" + " " * n + "b" for n in range(0, 60, 7)] + ["▁x", "\x00\x00 a\x00", " \n "]
    texts += ["".join(rng.choice("  \nabtheiné中▁<0>[](=\t") for _ in range(rng.randint(0, 30)))
              for _ in range(300)]
    texts += ["".join(lib.id_to_piece(rng.randint(259, 31999)).replace("▁", " ") for _ in range(6))
              for _ in range(300)]
    tok = piecetok.PieceModel.of(path)
    got = tok.encode(texts)
    assert got == [np.array(x, "<u4").tobytes() for x in lib.encode([t or "" for t in texts])]
    assert [tok.decode(x) for x in got] == [(t or "").replace("▁", " ") for t in texts]
    back = piecetok.decode(piecetok.encode(docs, path), path).select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter(
        (r[0], r[1] or "") for r in docs.select("doc_id", "text").collect())
    assert piecetok.digests(docs, path).where("not round_trip").count() == 0
    assert piecetok.digests(empty, path).count() == 0


def test_run_tokens_equal_words():
    """Tokens of a run of texts: each text's words by the plain definition, then the end."""
    import pyarrow as pa
    import xxhash

    from cardgrain.llm.common import words

    texts = [None, "", " ", "a b a", "  x\ty\v\fz\r\n", "ÀB c d \x1c e\x85f", "a\x00b  c", "A" * 70, None]
    for run in (texts, [None], ["", ""], [" q "]):
        t = ngrams.tokens(pa.array(run, pa.string()))
        each = [[*(xxhash.xxh64_intdigest(w) & int(ngrams.MASK63) for w in words(x)),
                 int(ngrams.END)] for x in run]
        assert t.hashes.tolist() == [h for x in each for h in x]
        assert t.first.tolist() == [sum(map(len, each[:i])) for i in range(len(each))]
        assert t.is_end.sum() == len(run)
        assert len(set(t.code.tolist())) == len(t.distinct)
