"""Fitted state on disk: plain Parquet tables, loaded explicitly."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


JSON_WORDS = 1_000_000


def save_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_features(features: DataFrame, path: str) -> None:
    """Feature and label rows, one folder per split, so that a split is read alone."""
    save_table(features, path, "split")


def load_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = load_table(spark, path)
    return df if split is None else df.filter(F.col("split") == split)


def vocabulary_of_json(spark: SparkSession, path: str) -> DataFrame:
    """``term, idx`` from a JSON object ``{word: index}`` (a top-k vocabulary)."""
    return spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,bigint>")).alias("term", "idx"))


def vocabulary_to_json(vocabulary: DataFrame, path: str) -> None:
    """The JSON form of a top-k vocabulary, one object in one file of at most ``JSON_WORDS`` words.
    For a vocabulary without a size limit use ``save_table``."""
    if vocabulary.limit(JSON_WORDS + 1).count() > JSON_WORDS:
        raise ValueError(f"more than {JSON_WORDS} words; save_table keeps vocabularies of any size")
    entries = F.array_sort(F.collect_list(F.struct("idx", "term")))
    words = vocabulary.agg(entries.alias("e")).select(
        F.map_from_arrays("e.term", "e.idx").alias("m"))
    words.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def save_settings(spark: SparkSession, settings: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(settings, ensure_ascii=False),)], "settings string").coalesce(
        1).write.mode("overwrite").parquet(path)


def load_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["settings"])
