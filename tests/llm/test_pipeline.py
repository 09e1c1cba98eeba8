"""The pipeline's stages against brute-force versions on the smallest tables."""

from collections import Counter

import numpy as np

import corpus_pipeline as cp
from cardgrain.llm import registry, simhash
from cardgrain.llm.common import prepare

SF = "/root/testdata/sf0.001"


def test_stages_keep_and_drop(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [s[0] for s in cp.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup",
                                         "packing"]
    kept = cp.quality_stage(spark, docs, SF)
    assert kept.columns == list(cp.COLUMNS)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert np.mean([d in ids for d in good]) > 0.97 and np.mean([d in ids for d in bad]) < 0.2

    told = cp.language_stage(spark, docs, SF)
    assert told.columns == list(cp.COLUMNS) and told.count() == docs.count()
    signs = docs.limit(1).selectExpr("-1L as doc_id", "'?? 12 !!' as text", "lang", "source", "n_chars")
    assert cp.language_stage(spark, docs.unionByName(signs), SF).where("doc_id = -1").count() == 0

    one = cp.near_copies_stage(spark, docs, SF)
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in docs.collect()}
    mask, seen, group = (1 << 64) - 1, {}, Counter()
    todo = set(prints)
    while todo:  # components by brute force, smallest id first
        root = min(todo)
        todo.discard(root)
        stack = [root]
        while stack:
            a = stack.pop()
            seen[a] = root
            near = {b for b in todo if ((prints[a] ^ prints[b]) & mask).bit_count() <= 3}
            todo -= near
            stack += near
    group.update(seen.values())
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == set(group)

    empty = docs.where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_run_packs_what_the_stages_keep(spark):
    rows = cp.run(spark, SF)
    ids = {r["doc_id"] for r in rows.select("doc_id").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = cp.near_copies_stage(spark, cp.language_stage(spark, cp.quality_stage(
        spark, docs, SF), SF), SF)
    assert ids == {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert set(registry.QUERIES) >= {"pipeline"} and cp.ORACLE_SQL is None
