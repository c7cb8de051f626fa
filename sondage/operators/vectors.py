"""Word vectors: average per row and text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distribute import BROADCAST_BYTES, lookup_join, materialize, order_cutoffs, table_bytes


def average_vectors(terms: DataFrame, embeddings: DataFrame, dim: int, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mean vector of the known words of each (row, text column), every occurrence
    counted. Rows without a known word are absent: ``zero_filled`` adds them.

    ``terms`` is a term table, ``embeddings`` has unique ``word`` and ``vec`` of
    length ``dim``. One plain sum per place keeps the aggregation in generated
    code, which is faster than a vector summary and never explodes the places.
    Of vectors beyond ``limit_bytes`` those of the words in most rows are broadcast and summed
    where the words are; only the others move, as they are given, once per row and word.
    """
    table = embeddings.select(F.col("word").alias("term"), "vec")
    size = table_bytes(table)
    if size <= limit_bytes:
        return _means(_sums(lookup_join(terms, table, ["term"], "row_id"), dim), dim)
    met = materialize(table.join(terms.groupBy("term").agg(F.count(F.lit(1)).alias("_rows")), "term"))
    words = met.count()
    most = int(limit_bytes / (size / table.count()))
    cut = order_cutoffs(met, "_rows", [words - most]).get(words - most, 0) if words > most else 0
    often = terms.join(F.broadcast(met.filter(F.col("_rows") > cut).drop("_rows")), "term")
    rest = lookup_join(terms, met.filter(F.col("_rows") <= cut).drop("_rows"), ["term"], "row_id", limit_bytes=limit_bytes)
    both = _sums(often, dim).unionByName(_sums(rest.select("row_id", "ordinal", "tf", "vec").repartition("row_id", "ordinal"), dim))
    return _means(both.groupBy("row_id", "ordinal").agg(*[F.sum(c).alias(c) for c in both.columns[2:]]), dim)


def _sums(hits: DataFrame, dim: int) -> DataFrame:
    """Occurrences ``n`` of known words and the sums ``s0, s1, ...`` of their places."""
    tf = F.col("tf").cast("double")
    return hits.groupBy("row_id", "ordinal").agg(
        F.sum(tf).alias("n"), *[F.sum(tf * F.get("vec", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(dim)])


def _means(sums: DataFrame, dim: int) -> DataFrame:
    mean = F.array(*[F.col(f"s{i}") / F.col("n") for i in range(dim)])
    return sums.select("row_id", "ordinal", mean.alias("vec"))


def zero_filled(rows: DataFrame, averages: DataFrame, row_id: str, n_cols: int, dim: int) -> DataFrame:
    """One row per (row, text column); the zero vector where nothing was averaged."""
    places = rows.select(F.col(row_id).alias("row_id"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_cols - 1))).alias("ordinal"))
    return (places.join(averages, ["row_id", "ordinal"], "left")
            .withColumn("vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim))))
