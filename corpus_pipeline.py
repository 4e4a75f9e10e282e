"""A training-corpus pipeline over the operators of ``wattline.llm``.

``STAGES`` are applied in order; each works on all that the one before has kept, as written by it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattline.llm import bpe, exact_dedup, mixing, near_dedup, quality
from wattline.llm.common import free_name, scratch, table

#: Documents that score below this go.
LEAST_QUALITY = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier accepts; it learns from the labelled ones among ``docs``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), use=~quality.held_out())
    score = free_name(docs, "score")
    return quality.score(docs, model, docs.columns, out_col=score, least=LEAST_QUALITY).drop(score)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal after normalising white space, the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles (similarity 0.8), the smallest id stays."""
    return near_dedup.keep_one(docs, width=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the words of each source come near its target."""
    return mixing.repeat_rows(docs, mixing.mix(docs, by_text=True))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digest and that of the text decoded from them."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, keep_ids=True).drop("decoded")


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", no_copies),
    ("minhash_near_dedup", no_near_copies),
    ("mix_sources", mixed_sources),
    ("byte_bpe", encoded),
]

#: Classifier, rounding and tokenizer have no SQL form: the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
