"""A corpus pipeline over ``documents``; see STAGES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sondage.llm import bpe, digest_index, langid, mixing, simhash
from sondage.llm.common import read
from sondage.llm.queries import tokenizer_path
from sondage.operators.distribute import shared_folder


LEAST_SCORE = 0.4
#: Expected tokens of each domain, as multiples of what the documents have. Clean text is asked for in full and a
#: little more, so that what is almost surely clean stays; the rate of a document is at most one.
TARGETS = {"clean": 1.03, "poor": 0.3, "toxic": 0.1}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in which no language has its share of the words, go."""
    return langid.keep_identified(docs, LEAST_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return digest_index.keep_one(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal fingerprints, the one with the smallest id stays."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poor and toxic documents are thinned until the expected tokens of the domains meet the targets."""
    return mixing.keep_mixed(docs, read(spark, sf_dir, "labels"), TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [("language", language), ("exact dedup", exact_dedup), ("simhash near-dedup", simhash_dedup), ("mixing", mix), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = shared_folder(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
