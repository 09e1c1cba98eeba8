"""Corpus preparation over whole documents: quality, language, near copies, packing.

``STAGES`` lists (name, function) in order. A stage takes (spark, docs,
sf_dir) and returns a DataFrame; :func:`run` writes each result as Parquet in
the shared folder and reads it back as the next stage's documents. All stages
but the last return the columns of ``documents``. Nulls, empty and repeated
rows and empty tables are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardgrain.llm import langid, packing, quality, registry, simhash
from cardgrain.llm.common import materialize, prepare

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_QUALITY = 0.5
MIN_COVERAGE = 0.2  # share of a text's n-grams that its language must know
TOKENIZER = "byte_bpe_50k.json"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a quality score of ``MIN_QUALITY`` or more, learned
    from the labels of the documents that are not held out."""
    prepare(spark)
    docs = _documents(docs)
    vectors, net = registry.learned_quality(spark, docs, sf_dir)
    return quality.keep(docs, vectors, net, MIN_QUALITY)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a language learned from ``lang``: those without a
    letter, or whose best language knows less than ``MIN_COVERAGE`` of the
    n-grams, go."""
    prepare(spark)
    docs = _documents(docs)
    filters = langid.learn(docs.where(~registry.held_out()))
    return langid.keep(docs, filters, MIN_COVERAGE)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest doc_id) of each group of near copies:
    SimHash over 3-word shingles, 3 bits or fewer apart."""
    prepare(spark)
    return simhash.keep_one(_documents(docs), shingle=3, max_bits=3)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack(_documents(docs), registry.tokenizer_path(TOKENIZER), end_id=1,
                        capacity=2048)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_copies_stage),
    ("packing", packing_stage),
]

# Classifier, filters and tokenizer have no SQL form; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
