"""The corpus pipeline: language ID, exact dedup, near-duplicate dedup, mixing, tokenising.

Each stage takes the documents that its predecessor kept, as written Parquet. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import exact_dedup, jaccard_join, language_id, queries, source_mixing
from ledgerflow.llm.shared import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language; null texts and texts without a letter go."""
    return language_id.accepted(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents: that with the smallest doc_id."""
    return jaccard_join.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources' blocks interleave."""
    return source_mixing.in_mixed_order(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and position in the mix of every document.

    The stage before has written the mix in order, so a document's place in its files is its position.
    """
    placed = source_mixing.with_positions(docs)
    both = placed.select(F.struct("doc_id", "position").alias("doc_id"), "text")
    out = queries.token_digests(both, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "doc_id.position")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: SQL cannot train the language model, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs
