"""Exact duplicates against plain grouping, with every odd kind of row."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cardgrain.llm import exactdup, golomb
from cardgrain.llm.common import prepare

SCHEMA = "doc_id long, text string, sha string, row long, __note string, kept string"


def lowered(text):
    return (text or "").encode().lower()


def plain(rows):
    """doc_id, keep_id, group_size, text_sha256 of each row, and kept rows of each group."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out, kept = [], {}
    for text, ids in groups.items():
        sha = hashlib.sha256(text).hexdigest()
        keep = max((i for i in ids if i is not None), default=None)
        kept[sha] = keep
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str), kept


def compare(df, rows):
    got = df.collect()
    want, kept = plain(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got],
                  key=str) == want
    stay = [(r["text_sha256"], r["doc_id"]) for r in got if r["kept"]]
    assert len(stay) == len(kept) and dict(stay) == kept


ROWS = [(1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, ""), (4, None), (5, "É"), (6, "é"),
        (7, "x"), (7, "x"), (7, "x"), (None, "x"), (None, "no id"), (None, "NO id"), (8, " same text"),
        (10, "a" * 2_000_000), (11, "A" * 2_000_000), (12, "a" * 2_000_000 + "b"), (13, "nul\x00"),
        (14, "nul"), (-5, "neg"), (-6, "neg")]


@pytest.fixture(scope="module")
def frame(spark):
    prepare(spark)
    return lambda rows, parts=4: spark.createDataFrame(
        [(i, t, "s", 1, "n", "k") for i, t in rows], SCHEMA).repartition(parts)


def test_matches_plain_grouping(frame):
    compare(exactdup.find(frame(ROWS)), ROWS)


def test_many_copies_over_files_and_senders(spark, frame, tmp_path, monkeypatch):
    """Small senders, read by file and position; a third of all rows are one text."""
    monkeypatch.setattr(exactdup, "SENDER_ROWS", 16)
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(150)}") for i in range(600)]
    path = str(tmp_path / "docs")
    frame(rows, 5).write.parquet(path)
    compare(exactdup.find(spark.read.parquet(path)), rows)


def test_only_suspects_keep_their_text(frame):
    rows = [(i, f"text {i}") for i in range(300)] + [(1000, "text 7")]
    located = exactdup.located(frame(rows).select("doc_id", "text"))
    flagged, _ = exactdup._suspects(located)
    assert flagged.where("text is not null").count() == 2


def test_strangers_with_one_fingerprint_stay_apart(frame, monkeypatch):
    """With hardly any room every text is a suspect; bytes decide."""
    monkeypatch.setattr(exactdup, "SPARE_BITS", -6)
    rows = [(i, f"text {i % 40}") for i in range(60)]
    compare(exactdup.find(frame(rows)), rows)


def test_empty_table_and_dropped_copies(frame):
    empty = frame(ROWS).where("false")
    assert exactdup.find(empty).count() == 0
    kept = exactdup.drop_copies(frame(ROWS))
    assert kept.columns == ["doc_id", "text", "sha", "row", "__note", "kept"]
    assert kept.count() == len(plain(ROWS)[1])


@pytest.mark.parametrize("top", [1, 40, 2**20, 2**52, 2**63 - 1])
def test_golomb_round_trip(top):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 17, 3000):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        base = int(values[0]) // 2 if len(values) else 0
        assert np.array_equal(golomb.decode(golomb.encode(values, base), base), values)


def test_golomb_is_close_to_the_bound():
    values = np.unique(np.random.default_rng(2).integers(0, 2**32, 2**16, dtype=np.uint64))
    assert len(golomb.encode(values, 0)) * 8 / len(values) < 32 - 16 + 2
