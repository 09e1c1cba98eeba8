"""Open sequences hold their pieces' ids, not whole documents; batches are bounded by bytes."""

import zlib

import numpy as np
import pyarrow as pa

from cardgrain.llm import packing, registry
from cardgrain.llm.common import arrow_map, prepare


def test_open_pieces_hold_their_own_ids_only():
    rng, packer = np.random.default_rng(1), packing.Packer(2048, 64, 0)
    docs, rows = {}, []
    for i in range(400):
        docs[i] = rng.integers(0, 50_000, int(rng.integers(20_000, 60_000))).astype("<u4").tobytes()
        rows += packer.add(i, docs[i])
        held = sum(len(p[3]) for pieces in packer.open.values() for p in pieces)
        assert held < 4 * 2048 * 64
    rows += packer.rest()
    placed, used = {}, {}
    for doc_id, start, n, crc, total, seq, at in rows:
        assert crc == zlib.crc32(docs[doc_id][4 * start:4 * (start + n)]) and total == len(docs[doc_id]) // 4
        placed.setdefault(doc_id, []).append((start, n))
        used.setdefault(seq, []).append((at, n))
    for i, ids in docs.items():
        ends = [0] + [s + n for s, n in sorted(placed[i])]
        assert [s for s, _ in sorted(placed[i])] == ends[:-1] and ends[-1] == len(ids) // 4
    for pieces in used.values():
        ends = [0] + [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 2048


def test_a_very_long_text_and_batches_by_bytes(spark):
    prepare(spark)
    df = spark.range(40).selectExpr("id as doc_id", "repeat('word after word ', 200000) as text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield {"n": [b.num_rows], "bytes": [b.nbytes]}
    got = arrow_map(df.select("text"), sizes, "n long, bytes long", plain=False).collect()
    assert sum(r["n"] for r in got) == 40 and max(r["bytes"] for r in got) < 80_000_000
    long = spark.createDataFrame([(1, "a long text, " * 4_000_000)], "doc_id long, text string")
    rows = packing.pack(long, registry.tokenizer_path("byte_bpe_50k.json"), 1).collect()
    assert sum(r["length"] for r in rows) == rows[0]["doc_tokens"] > 10_000_000
    assert pa.__version__
