"""Multinomial naive Bayes by aggregation on long feature tables.

The classes of a feature are summed side by side, so fitting is one grouping by
feature and scoring one join on the feature plus one grouping by row. Features
without any count need no row: their probability is the same for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distribute import lookup_join, materialize
from .metrics import class_scores


@dataclass
class BayesModel:
    """``table``: idx, lp (log probability per class), n. ``unseen``: log probability
    per class of a feature that no training row has."""

    classes: list[str]
    log_prior: list[float]
    unseen: list[float]
    table: DataFrame

    def priors(self) -> DataFrame:
        return self.table.sparkSession.createDataFrame(
            list(zip(self.classes, self.log_prior)), "class string, log_prior double")

    def parameters(self) -> DataFrame:
        """``class, idx, log_prob``."""
        rows = F.array(*[F.struct(F.lit(c).alias("class"), F.get("lp", F.lit(i)).alias("log_prob"))
                         for i, c in enumerate(self.classes)])
        return self.table.select("idx", F.inline(rows)).select("class", "idx", "log_prob")


def _class_sum(label: str, c: str, extra: Column | None = None) -> Column:
    hit = F.col(label).cast("string") == c
    hit = hit if extra is None else hit & extra
    return F.coalesce(F.sum(F.when(hit, F.col("value"))), F.lit(0.0))


def fit_bayes(features: DataFrame, label: str, class_rows: dict[str, int], width: int,
              alpha: float = 0.5) -> BayesModel:
    """``class_rows``: training rows per class; the prior is their plain share."""
    classes = sorted(class_rows)
    n = sum(class_rows.values())
    sums = materialize(features.groupBy("idx").agg(
        *[_class_sum(label, c).alias(f"o{i}") for i, c in enumerate(classes)], F.count(F.lit(1)).alias("n")))
    totals = sums.agg(*[F.coalesce(F.sum(f"o{i}"), F.lit(0.0)).alias(f"o{i}")
                        for i in range(len(classes))]).first()
    mass = [totals[i] + alpha * width for i in range(len(classes))]
    lp = F.array(*[F.log((F.col(f"o{i}") + F.lit(alpha)) / F.lit(m)) for i, m in enumerate(mass)])
    return BayesModel(classes, [log(class_rows[c] / n) for c in classes],
                      [log(alpha / m) for m in mass], sums.select("idx", lp.alias("lp"), "n"))


def score_bayes(features: DataFrame, rows: DataFrame, model: BayesModel) -> DataFrame:
    """``rows`` (``row_id`` and any other columns) with ``scores`` and ``prediction``.

    A row without features is decided by the prior."""
    unseen = F.array(*[F.lit(u) for u in model.unseen])
    known = lookup_join(features.select("row_id", "idx", "value"), model.table, ["idx"], "row_id", "left")
    known = known.withColumn("lp", F.coalesce("lp", unseen))
    sums = known.groupBy("row_id").agg(*[
        F.sum(F.col("value") * F.get("lp", F.lit(i))).alias(f"_s{i}") for i in range(len(model.classes))])
    joined = rows.join(sums, "row_id", "left")
    return _decided(joined, model.classes, [F.lit(p) for p in model.log_prior])


def _decided(joined: DataFrame, classes: Sequence[str], prior: Sequence[Column]) -> DataFrame:
    """Add ``scores`` and the class with the highest one; ties go to the first class."""
    scores = F.array(*[F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + p for i, p in enumerate(prior)])
    best = F.array_min(F.array(*[F.struct(
        (-F.round(F.get("scores", F.lit(i)), 9)).alias("w"), F.lit(i).alias("i"), F.lit(c).alias("c"))
        for i, c in enumerate(classes)]))
    return (joined.withColumn("scores", scores).withColumn("prediction", best["c"])
            .drop(*[f"_s{i}" for i in range(len(classes))]))


def cross_predict(features: DataFrame, rows: DataFrame, label: str, fold: str, n_folds: int, width: int,
                  alpha: float = 0.5) -> DataFrame:
    """Prediction of every row by the model of the other folds.

    One grouping counts all folds; the training counts of a fold are the rest.
    ``features`` and ``rows`` both hold ``row_id``, ``label`` and ``fold``.
    """
    sizes = rows.groupBy(F.col(label).cast("string").alias("c"), F.col(fold).alias("f")).agg(
        F.count(F.lit(1)).alias("n")).collect()  # classes x folds rows
    classes = sorted({r["c"] for r in sizes})
    train = {(c, f): sum(r["n"] for r in sizes if r["c"] == c and r["f"] != f)
             for c in classes for f in range(n_folds)}
    n_train = {f: sum(train[c, f] for c in classes) for f in range(n_folds)}
    rest = {(i, f): F.col(f"t{i}") - F.col(f"o{i}_{f}") for i in range(len(classes)) for f in range(n_folds)}
    sums = materialize(features.groupBy("idx").agg(
        F.count(F.lit(1)).alias("n"), *[_class_sum(label, c).alias(f"t{i}") for i, c in enumerate(classes)],
        *[_class_sum(label, c, F.col(fold) == f).alias(f"o{i}_{f}")
          for i, c in enumerate(classes) for f in range(n_folds)]))
    mass = sums.agg(*[F.sum(v).alias(f"m{i}_{f}") for (i, f), v in rest.items()]).first()
    lps = F.array(*[F.array(*[
        F.log((rest[i, f] + F.lit(alpha)) / F.lit(mass[f"m{i}_{f}"] + alpha * width))
        for i in range(len(classes))]) for f in range(n_folds)])
    table = materialize(sums.select("idx", lps.alias("lps"), "n"))
    known = lookup_join(features.select("row_id", fold, "idx", "value"), table, ["idx"], "row_id")
    lp = F.get(F.col("lps"), F.col(fold))
    scored = known.groupBy("row_id").agg(*[
        F.sum(F.col("value") * F.get(lp, F.lit(i))).alias(f"_s{i}") for i in range(len(classes))])
    never = float("-inf")
    prior = [F.element_at(F.array(*[F.lit(log(train[c, f] / n_train[f]) if train[c, f] else never)
                                    for f in range(n_folds)]), F.col(fold) + 1) for c in classes]
    return _decided(rows.join(scored, "row_id", "left"), classes, prior)


def cross_scores(predicted: DataFrame, label: str, fold: str) -> DataFrame:
    """Macro F1 (mean and two population deviations over folds) and mean accuracy."""
    by_fold = predicted.withColumn("_f", F.col(fold))
    pairs = by_fold.groupBy("_f", F.col(label).cast("string").alias("y"), F.col("prediction").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    per_fold = class_scores(pairs, ["_f"]).groupBy("_f").agg(
        F.avg("f1").alias("f1"), (F.sum("hit") / F.sum("support")).alias("acc"))
    return per_fold.agg(F.avg("f1").alias("f1_mean"), (F.stddev_pop("f1") * 2).alias("f1_spread"),
                        F.avg("acc").alias("accuracy"))
