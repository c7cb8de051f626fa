"""Registry of the example queries over the given tables, with their SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.distribute import shared_folder
from ..sources.tables import read_table, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` is the equivalent DuckDB query."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    scan = read_table(spark, f"{folder}/{name}.parquet")
    # The given tables of long texts are single files, which one task would read alone.
    return spread(scan) if name in ("documents", "conversations", "embeddings") else scan


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return shared_folder(spark)


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# SQL counterparts of the text expressions.
WORDS = r"'[\p{L}\p{N}_]+'"


def sql_tokens(text: str, stop=None, min_len: int = 1) -> str:
    words = f"regexp_extract_all(lower(coalesce({text}, '')), {WORDS})"
    if min_len > 1:
        words = f"list_filter({words}, lambda w: length(w) >= {min_len})"
    if stop:
        words = f"list_filter({words}, lambda w: w NOT IN ({sql_list(stop)}))"
    return words
