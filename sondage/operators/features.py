"""Feature matrices as long sparse tables ``row_id, [label,] idx, value``.

A zero is never stored. ``sparse_vectors`` is the edge to Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distribute import first_ranked, lookup_join


def places(values: Column, offset: int) -> Column:
    """``array<struct<idx, value>>`` of a dense array, zeros left out."""
    pairs = F.transform(values, lambda v, i: F.struct(
        (i + offset).cast("long").alias("idx"), v.cast("double").alias("value")))
    return F.filter(pairs, lambda p: p["value"] != 0)


def feature_totals(features: DataFrame) -> DataFrame:
    """Per feature: non-zero count, mean and squared deviation of the non-zeros."""
    return features.groupBy("idx").agg(
        F.count(F.lit(1)).alias("nnz"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))


def fit_scale(features: DataFrame, n_rows: int) -> DataFrame:
    """Mean and population deviation per feature over all rows, stored or not.

    Joins the statistics of the stored values with those of the implied zeros,
    which is stable where ``E[x^2] - E[x]^2`` is not. A constant feature gets
    scale 1.
    """
    n = F.lit(float(n_rows))
    nnz = F.col("nnz").cast("double")
    var = (nnz * F.col("v") + nnz * (n - nnz) / n * F.col("m") * F.col("m")) / n
    sd = F.sqrt(var)
    return feature_totals(features).select(
        "idx", (nnz * F.col("m") / n).alias("mean"),
        F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias("scale"), F.col("nnz").alias("n"))


def scale_features(features: DataFrame, scales: DataFrame) -> DataFrame:
    """Divide by the deviation, without centring (keeps the table sparse)."""
    known = lookup_join(features, scales.select("idx", "scale", "n"), ["idx"], "row_id", "left")
    return known.withColumn("value", F.col("value") / F.coalesce("scale", F.lit(1.0))).drop("scale", "n")


def dense_moments(df: DataFrame, vec: str) -> list[tuple[float, float]]:
    """Mean and population deviation per place of a dense array; one driver row."""
    s = Summarizer.metrics("mean", "variance", "count").summary(
        array_to_vector(F.col(vec).cast("array<double>")))
    row = df.select(s.alias("s")).select(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"),
        F.col("s.count").alias("n")).first()
    shrink = (row["n"] - 1) / row["n"]
    sds = [float(np.sqrt(v * shrink)) for v in row["var"]]
    return [(m, sd if sd > 0 else 1.0) for m, sd in zip(row["mean"], sds)]


def standardize(df: DataFrame, vec: str, moments: Sequence[tuple[float, float]],
                out: str | None = None) -> DataFrame:
    """Centre and scale a dense array column."""
    means = F.array(*[F.lit(float(m)) for m, _ in moments])
    sds = F.array(*[F.lit(float(s)) for _, s in moments])
    centred = F.zip_with(F.col(vec).cast("array<double>"), means, lambda x, m: x - m)
    return df.withColumn(out or vec, F.zip_with(centred, sds, lambda x, s: x / s))


def chi2_scores(features: DataFrame, label: str, shares: dict[str, float]) -> DataFrame:
    """Chi-square of each feature against the class: ``sum((O - E)^2 / E)``.

    O is the class sum of the values, E the class share of the feature total.
    All classes of a feature are summed in one pass, side by side; a feature
    whose total is 0 has no score.
    """
    cells = features.groupBy("idx").agg(F.sum("value").alias("total"), *[
        F.coalesce(F.sum(F.when(F.col(label).cast("string") == c, F.col("value"))), F.lit(0.0)).alias(f"o{i}")
        for i, c in enumerate(shares)])
    score = F.lit(0.0)
    for i, share in enumerate(shares.values()):
        expected = F.col("total") * F.lit(share)
        score = score + (F.col(f"o{i}") - expected) * (F.col(f"o{i}") - expected) / expected
    return cells.select("idx", "total", F.when(F.col("total") != 0, score).alias("chi2"))


def select_top(scores: DataFrame, k: int, score: str = "chi2", digits: int = 9) -> DataFrame:
    """The ``k`` best features with a new dense index in the old order.

    Scores are compared after rounding, so that the order of a sum cannot
    decide; ties go to the smaller index. Features without a score come last.
    """
    worst = F.lit(float("inf"))
    best = first_ranked(scores, [F.coalesce(-F.round(score, digits), worst), F.col("idx")], k, "_rank")
    return first_ranked(best.drop("_rank"), [F.col("idx")], k, "new_idx")


def apply_mask(features: DataFrame, kept: DataFrame) -> DataFrame:
    """Keep the selected features and renumber them."""
    return (lookup_join(features, kept.select("idx", "new_idx"), ["idx"], "row_id")
            .drop("idx").withColumnRenamed("new_idx", "idx"))


def packed_cells(features: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (unique ``row_id`` and other columns) with their features as ``cells``: an array of ``idx, value`` by place."""
    cells = features.groupBy("row_id").agg(F.array_sort(F.collect_list(
        F.struct(F.col("idx").cast("int").alias("idx"), "value"))).alias("cells"))
    return rows.join(cells, "row_id", "left")


def cell_vectors(packed: DataFrame, width: int, cells: Column | None = None) -> DataFrame:
    """The ML vector of each row of ``packed_cells``; ``cells`` may be an expression over them."""
    @F.pandas_udf(VectorUDT())
    def pack(idx: pd.Series, value: pd.Series) -> pd.DataFrame:
        n = len(idx)
        return pd.DataFrame({"type": np.zeros(n, np.int8), "size": np.full(n, width, np.int32),
                             "indices": idx, "values": value})

    packed = packed if cells is None else packed.withColumn("cells", cells)
    idx = F.coalesce("cells.idx", F.array().cast("array<int>"))
    value = F.coalesce("cells.value", F.array().cast("array<double>"))
    return packed.withColumn("features", pack(idx, value)).drop("cells")


def sparse_vectors(features: DataFrame, width: int, rows: DataFrame) -> DataFrame:
    """``rows`` (unique ``row_id`` and other columns) with their ML vector."""
    return cell_vectors(packed_cells(features, rows), width)


def matrix_shape(features: DataFrame, rows: DataFrame, width: int, split: str = "split",
                 label: str = "label") -> DataFrame:
    """Rows, feature width and labelled rows per split."""
    stored = features.groupBy(split).agg(F.count(F.lit(1)).alias("nonzeros"))
    return (rows.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"), F.count(label).alias("n_labels"))
            .join(stored, split, "left")
            .select(split, "n_rows", F.lit(width).cast("long").alias("width"), "n_labels",
                    F.coalesce("nonzeros", F.lit(0)).alias("nonzeros")))
