"""Training corpus from raw documents: five stages, each written before the next one reads it.

Low quality goes first, since its score needs nothing but the document itself; then exact copies, near copies (five-word
shingles, similarity 0.8), documents with benchmark items; what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fulluse.llm import bpe, decontaminate, exact_dedup, jaccard, quality
from fulluse.llm.common import Scratch, documents


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter("kept").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.kept_rows(docs, Scratch(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id."""
    return jaccard.kept_rows(docs, Scratch(spark), width=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian 32-bit numbers) and digests of ids and decoded text."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]

#: A trained classifier and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
