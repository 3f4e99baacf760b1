"""Corpus pipeline over ``documents``: keep what is in a known language, once,
without near copies, mixed to target weights, and tokenised.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage
before; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import exact_dedup, jaccard_join, language_id, mixing, piece_bpe
from sessionlake.llm.common import cut, lower_batches
from sessionlake.llm.queries import tokenizer_path

#: No document more often than once; clean prose is used up, junk and toxic text is thinned.
MAX_RATE = 1.0
#: Rows that go to a Python worker at a time. Stages are lazy, so the session keeps the setting.
BATCH = 1000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rejected documents go."""
    lower_batches(spark, BATCH)
    return language_id.identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the largest id stays."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the least id stays."""
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights, with domains learned from the labelled table."""
    lower_batches(spark, BATCH)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mixing.learn(docs, mixing.domains_of(labels))
    return mixing.mix(docs, model, mixing.WEIGHTS, MAX_RATE)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids, their count, and digests of ids and decoded text."""
    lower_batches(spark, BATCH)
    both = piece_bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", tokenised),
]

#: The stages learn models and tokenise, which SQL can't express; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
