"""Registered queries of the text operators: name -> builder(spark, sf_dir)."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardgrain.llm import convtrie, exactdup, langid, ngrams, nndescent, packing, piecetok, quality, simhash, sketch, urlfilter, vafile, wavelet
from cardgrain.llm.common import fold, prepare

QUERIES = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def held_out():
    """Rows that nothing is learned from: crc32 of the id, modulo 3, is 1."""
    return fold(F.col("doc_id"), 3) == 1


def learned_quality(spark, docs, sf_dir):
    """(word vectors, network) from the texts of ``docs`` and the labels that may be learned."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select(
        "doc_id", F.col("quality").alias("label"))
    vectors = quality.word_vectors(docs)
    return vectors, quality.learn(docs, labels, vectors)


@query
def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs, *learned_quality(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_ngram_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = fold(F.col("doc_id"), 10) == 0
    scored = ngrams.score(docs, ngrams.learn(docs.where(~out)))
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                        end_id=1, capacity=2048)


@query
def op6_fingerprints(spark, sf_dir):
    return sketch.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_token_files(spark, sf_dir):
    return wavelet.read_digests(wavelet.write_shards(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2))


@query
def op8_vector_links(spark, sf_dir):
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op9_url_rules(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark))


@query
def op10_pieces(spark, sf_dir):
    return piecetok.digests(table(spark, sf_dir, "documents"),
                            tokenizer_path("piece_bpe_32k.model"))


@query
def op11_exact_copies(spark, sf_dir):
    return exactdup.find(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark, sf_dir):
    return convtrie.shared_prefixes(table(spark, sf_dir, "conversations"))


@query
def op13_clusters(spark, sf_dir):
    return vafile.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES = {"op9_url_rules": urlfilter.ORACLE, "op11_exact_copies": exactdup.ORACLE,
           "op12_prefix_trie": convtrie.ORACLE, "op13_clusters": vafile.oracle()}
