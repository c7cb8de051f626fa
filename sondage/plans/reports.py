"""Tuning and comparison reports: fit on train, choose on validation, refit on
both, score on test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import (
    FOREST_DEPTHS, FOREST_SIZES, NEIGHBOUR_COUNTS, RIDGE_STRENGTHS, VOCABULARY_SIZES)
from ..operators import features as feats, metrics, models, neighbours, records, splits
from ..operators.distribute import materialize
from .pipeline import FeaturePipeline, prepared


def ml_rows(df: DataFrame, vec: str, label: str, classes: Sequence[str],
            keep: Sequence[str] = ()) -> DataFrame:
    """Dense array rows as ML input."""
    rows = records.encode_label(df, classes, label).filter(F.col("label_idx").isNotNull())
    return rows.select(*keep, F.col("label_idx").cast("double").alias("label_idx"),
                       array_to_vector(F.col(vec).cast("array<double>")).alias("features"))


def compare_defaults(rows: DataFrame, row_id: str, vec: str, label: str, classes: Sequence[str],
                     trees: int = 100, depth: int = 30) -> DataFrame:
    """Validation accuracy of 5 neighbours, a forest and Gaussian Bayes.

    ``rows`` has ``split``; trees grow to the deepest level Spark allows.
    """
    rows = rows.persist()
    data = ml_rows(rows, vec, label, classes, ["split"]).persist()

    def neighbours_accuracy(train: DataFrame, val: DataFrame) -> float:
        found = neighbours.nearest(rows.filter("split = 'val'"), rows.filter("split = 'train'"), 5,
                                   query_id=row_id, ref_id=row_id, vec=vec, label=label)
        got = found.select("query_id", neighbours.vote("neighbours", 5).alias("p"))
        return metrics.accuracy_of(rows.filter("split = 'val'").join(got, F.col(row_id) == F.col("query_id")),
                                   label, "p")

    found = models.compare({
        "KNN": neighbours_accuracy,
        "Random Forest": lambda t, v: models.forest_accuracy(t, v, trees, depth),
        "Naive Bayes": lambda t, v: models.accuracy(models.gaussian_bayes().fit(t), v),
    }, data.filter("split = 'train'"), data.filter("split = 'val'"))
    data.unpersist()
    rows.unpersist()
    return found


def _named(predicted: DataFrame, classes: Sequence[str]) -> DataFrame:
    """``y, p`` as class names from the indexes of a fitted model."""
    names = F.array(*[F.lit(c) for c in classes])
    return predicted.select(F.element_at(names, F.col("label_idx").cast("int") + 1).alias("y"),
                            F.element_at(names, F.col("prediction").cast("int") + 1).alias("p"))


def evaluate(model: Model, rows: DataFrame, classes: Sequence[str]) -> tuple[dict[str, float], DataFrame]:
    """Accuracy, macro and weighted F1, and the classification report of ML rows."""
    named = materialize(_named(model.transform(rows), classes))
    return metrics.summary_metrics(named, "y", "p"), metrics.classification_report(named, "y", "p")


def tuned_forest(train: DataFrame, val: DataFrame, classes: Sequence[str], fold: str = "fold",
                 **grid) -> tuple[float, dict, dict[str, float]]:
    """Cross-validated grid search: best score, its setting, metrics on validation rows."""
    model, table = models.forest_cross_validation(train, fold, **grid)
    best = metrics.best_setting(table, "accuracy", "position").first()
    setting = {k: best[k] for k in ("trees", "depth", "min_leaf")}
    return best["accuracy"], setting, evaluate(model, val, classes)[0]


def forest_errors(train: DataFrame, test: DataFrame, classes: Sequence[str], trees: int = 300, depth: int = 10,
                  min_leaf: int = 5, seed: int = 311) -> tuple[float, DataFrame, DataFrame]:
    """Test accuracy of a forest, its ten most frequent mistakes, and the usual one per label."""
    model = models.forest(trees, depth, min_leaf, seed).fit(train)
    named = materialize(_named(model.transform(test), classes))
    return (metrics.accuracy_of(named, "y", "p"), metrics.error_pairs(named, "y", "p"),
            metrics.usual_confusion(named, "y", "p"))


@dataclass
class Report:
    summary: DataFrame        # model, val_accuracy, test_accuracy, setting
    best: str
    predictions: DataFrame    # y, p of the best model on the test rows

    def confusion(self) -> DataFrame:
        return metrics.confusion_matrix(self.predictions, "y", "p", true_labels_only=True)

    def classes(self) -> DataFrame:
        return metrics.classification_report(self.predictions, "y", "p")


def _first_best(rows: list, metric: str):
    best = None
    for r in rows:
        if best is None or r[metric] > best[metric]:
            best = r
    return best


def full_report(rows: DataFrame, row_id: str, vec: str, label: str, classes: Sequence[str],
                strengths: Sequence[float] = RIDGE_STRENGTHS, sizes: Sequence[int] = FOREST_SIZES,
                depths: Sequence[int] = FOREST_DEPTHS, ks: Sequence[int] = NEIGHBOUR_COUNTS) -> Report:
    """Tune logistic regression, forest and neighbours; the best model is the one
    with the highest test accuracy (the first on ties)."""
    rows = rows.persist()
    data = ml_rows(rows, vec, label, classes, ["split"]).persist()
    train, val, test = (data.filter(F.col("split") == s) for s in splits.SPLITS)
    both = splits.train_and_val(data)
    n_both = both.count()
    results: list[tuple[str, float, str, DataFrame]] = []  # model, validation accuracy, setting, predictions

    c = _first_best(models.ridge_sweep(train, val, strengths, 200).orderBy("position").collect(), "val_accuracy")
    ridge = models.ridge_logistic(c["strength"], n_both).fit(both)
    results.append(("Logistic Regression", c["val_accuracy"], f"strength={c['strength']}",
                    _named(ridge.transform(test), classes)))

    f = _first_best(models.forest_sweep(train, val, sizes, depths).orderBy("position").collect(), "val_accuracy")
    grown = models.forest(f["trees"], f["depth"], 1, 311).fit(both)
    results.append(("Random Forest", f["val_accuracy"], f"trees={f['trees']} depth={f['depth']}",
                    _named(grown.transform(test), classes)))

    k, k_accuracy, voted = tuned_neighbours(rows, row_id, vec, label, ks)
    results.append(("KNN", k_accuracy, f"k={k}", voted))

    table, best, best_score, best_rows = [], "", -1.0, results[0][3]
    for i, (name, val_accuracy, setting, predictions) in enumerate(results):
        score = metrics.accuracy_of(predictions, "y", "p")
        table.append((i, name, float(val_accuracy), float(score), setting))
        if score > best_score:
            best, best_score, best_rows = name, score, predictions
    summary = rows.sparkSession.createDataFrame(
        table, "position int, model string, val_accuracy double, test_accuracy double, setting string")
    best_rows = materialize(best_rows)
    data.unpersist()
    rows.unpersist()
    return Report(summary, best, best_rows)


def tuned_neighbours(rows: DataFrame, row_id: str, vec: str, label: str, ks: Sequence[int] = NEIGHBOUR_COUNTS
                     ) -> tuple[int, float, DataFrame]:
    """The ``k`` with the best distance-weighted vote on the validation rows (the first on ties), its accuracy there, and
    ``y, p`` of the test rows among train and validation; vectors standardised by the rows searched."""
    def searched(refs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        moments = feats.dense_moments(refs, vec)
        found = neighbours.nearest(
            feats.standardize(queries, vec, moments), feats.standardize(refs, vec, moments), k,
            query_id=row_id, ref_id=row_id, vec=vec, label=label)
        return queries.select(row_id, F.col(label).alias("y")).join(found, F.col(row_id) == F.col("query_id"))

    part = {s: rows.filter(F.col("split") == s) for s in splits.SPLITS}
    sweep = neighbours.k_sweep(searched(part["train"], part["val"], max(ks)), "y", ks)
    best = _first_best(sweep.orderBy("position").collect(), "accuracy")
    found = searched(splits.train_and_val(rows), part["test"], best["k"])
    return best["k"], best["accuracy"], found.select(
        F.col("y").cast("string").alias("y"), neighbours.vote("neighbours", best["k"], "distance").cast("string").alias("p"))


def vocabulary_size_sweep(train: DataFrame, plan: FeaturePipeline, label: str, classes: Sequence[str],
                          sizes: Sequence[int] = VOCABULARY_SIZES, **grid) -> DataFrame:
    """Best cross-validated forest per vocabulary size.

    A vocabulary is ordered by rank, so that every size is a prefix of the largest: the words are counted, and the features
    built and brought together by row once, for the largest size, and cut inside the rows for the others. Returns one row per size, best accuracy first
    reached is the choice (``metrics.best_setting``).
    """
    row_id = plan.config.row_id
    train = prepared(train, plan.config, [c for c in (label,) if c != row_id])
    model = FeaturePipeline(replace(plan.config, dict_len=max(sizes))).fit(train)
    features = materialize(model.transform(train))
    folds = splits.kfold_stratified(train.select(row_id, label), row_id, label, seed=42)
    folds = records.encode_label(folds, classes, label).select(
        F.col(row_id).alias("row_id"), "fold", F.col("label_idx").cast("double").alias("label_idx")).persist()
    packed = feats.packed_cells(features, folds).persist()
    out = []
    for i, size in enumerate(sizes):
        cells, width = model.cells_of(size, F.col("cells"))
        data = feats.cell_vectors(packed, width, cells).persist()
        _, table = models.forest_cross_validation(data, **grid)
        best = metrics.best_setting(table, "accuracy", "position").first()
        out.append((i, size, best["trees"], best["depth"], best["min_leaf"], best["accuracy"]))
        data.unpersist()
    packed.unpersist()
    folds.unpersist()
    return train.sparkSession.createDataFrame(
        out, "position int, dict_len int, trees int, depth int, min_leaf int, accuracy double")
