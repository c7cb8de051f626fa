"""Classifiers of Spark ML with the settings of the survey study, and their sweeps.

Rows hold ``features`` (ML vector) and ``label_idx`` (double). Grids are
parameters; the defaults are the full ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CV_DEPTHS, CV_MIN_LEAF, CV_TREES, FOREST_DEPTHS, FOREST_SIZES, RIDGE_STRENGTHS
from . import forest as forests, grove, metrics
from .distribute import checkpoint_folder, materialize, shared_folder

MOST_DEPTH = 30
GROWN_AT_ONCE = 500_000  # nodes that the trees of a fit, or of all fits of a grid, may come to with Spark's learner; the driver holds them
LAYER_BYTES = 64 * 1024 * 1024
COLUMNS = {"featuresCol": "features", "labelCol": "label_idx"}


def accuracy(model: Model, rows: DataFrame) -> float:
    return metrics.accuracy_of(model.transform(rows), "label_idx", "prediction")


def gaussian_bayes() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian", **COLUMNS)


def forest(trees: int = 150, depth: int = 10, min_leaf: int = 2, seed: int = 42) -> RandomForestClassifier:
    """Spark has no minimum size for splitting a node, only one for the parts, and grows trees to depth
    30 at most; a larger depth is an error rather than a silently smaller forest.

    The node that a row has reached in each tree is kept with the row, so that the grown trees are not sent to every task of
    every step and rows do not walk them again from the root; the forest is the same."""
    if depth > MOST_DEPTH:
        raise ValueError(f"depth {depth} is over {MOST_DEPTH}, the most that Spark's trees can have")
    spark = SparkSession.getActiveSession()
    if spark is not None and (spark.sparkContext.master.startswith("local") or spark.conf.get("spark.checkpoint.dir", None)):
        checkpoint_folder(spark)  # every tenth step is written there
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
                                  seed=seed, cacheNodeIds=True, **COLUMNS)


def ridge_logistic(strength: float, n_rows: int, max_iter: int = 200) -> LogisticRegression:
    """L2 logistic regression; ``strength`` multiplies the summed loss, so the mean-loss
    penalty of Spark is 1 / (strength * rows)."""
    return LogisticRegression(regParam=1.0 / (strength * n_rows), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter, family="multinomial", **COLUMNS)


def perceptron(n_features: int, n_classes: int, hidden: Sequence[int] = (64,), max_iter: int = 200,
               seed: int = 42) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, n_classes], maxIter=max_iter,
                                          blockSize=64, seed=seed, **COLUMNS)


def _rows(df: DataFrame, rows: list, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def ridge_sweep(train: DataFrame, val: DataFrame, strengths: Sequence[float] = RIDGE_STRENGTHS,
                max_iter: int = 20) -> DataFrame:
    """Validation accuracy per strength."""
    n = train.count()
    out = [(i, float(c), accuracy(ridge_logistic(c, n, max_iter).fit(train), val))
           for i, c in enumerate(strengths)]
    return _rows(train, out, "position int, strength double, val_accuracy double")


def most_nodes(n_rows: int, trees: int, depth: int) -> int:
    """Bound of the nodes of a forest over so many rows."""
    return trees * (2 * n_rows if depth > 20 else min(2 * n_rows, 2 << depth))


def forest_sweep(train: DataFrame, val: DataFrame, sizes: Sequence[int] = FOREST_SIZES,
                 depths: Sequence[int] = FOREST_DEPTHS, seed: int = 311) -> DataFrame:
    """Train and validation accuracy per (trees, depth).

    One forest of the largest size is grown per depth; the smaller ones are its first trees, and one walk through
    all of them scores every size. Where the trees may come to more than ``GROWN_AT_ONCE`` nodes they are grown in tasks, to the
    largest depth (``grove``): up to a smaller depth they are the trees of that depth."""
    n = train.count()
    if len(set(depths)) * most_nodes(n, max(sizes), max(depths)) > GROWN_AT_ONCE and grove.fits(train, n + val.count()):
        learner = forest(max(sizes), max(depths), 1, seed)
        parts = [rows.select("label_idx", "features", F.lit(i).alias("part")) for i, rows in enumerate((train, val))]
        table = grove.held(parts[0].union(parts[1]), grove.thresholds(train, n))
        job = grove.Growth(0, (0,), (0, 1), learner.getNumTrees(), learner.getMaxDepth(), learner.getMinInstancesPerNode(), seed)
        found = grove.grown_accuracies(train.sparkSession, [table], [job], sizes, sorted(set(depths)))
        out = [(i, s, d, found[0, 0, s, d], found[0, 1, s, d]) for i, (s, d) in enumerate(product(sizes, depths))]
        return _rows(train, out, "position int, trees int, depth int, train_accuracy double, val_accuracy double")
    scores = {}
    for d in dict.fromkeys(depths):
        nodes = node_table(forest(max(sizes), d, 1, seed).fit(train))
        scores[d] = [prefix_accuracies(rows, nodes, sizes) for rows in (train, val)]
    out = [(i, n, d, *(scores[d][part][sizes.index(n)] for part in (0, 1))) for i, (n, d) in enumerate(product(sizes, depths))]
    return _rows(train, out, "position int, trees int, depth int, train_accuracy double, val_accuracy double")


def forest_accuracy(train: DataFrame, val: DataFrame, trees: int, depth: int, min_leaf: int = 1, seed: int = 42,
                    at_once: int = GROWN_AT_ONCE) -> float:
    """Accuracy of a forest of ``trees`` trees. If they may come to more than ``at_once`` nodes they are grown in tasks
    (``grove``), of more rows than the workers can hold over several fits, with a seed each, whose class shares are added up:
    the driver never holds more than ``at_once`` nodes (or one tree)."""
    n = train.count()
    most = most_nodes(n, 1, depth)
    each = max(1, min(trees, at_once // max(most, 1)))
    if each == trees:
        return accuracy(forest(trees, depth, min_leaf, seed).fit(train), val)
    if grove.fits(train, n + val.count()):
        forest(trees, depth, min_leaf, seed)
        parts = [rows.select("label_idx", "features", F.lit(i).alias("part")) for i, rows in enumerate((train, val))]
        table = grove.held(parts[0].union(parts[1]), grove.thresholds(train, n))
        job = grove.Growth(0, (0,), (1,), trees, depth, min_leaf, seed)
        return grove.grown_accuracies(train.sparkSession, [table], [job], [trees], [depth])[0, 1, trees, depth]
    rows = val.select("label_idx", "features", F.lit(None).cast("array<double>").alias("votes"))
    for i, start in enumerate(range(0, trees, each)):
        model = forest(min(each, trees - start), depth, min_leaf, seed + i).fit(train)
        voted = model.transform(rows).withColumn("raw", vector_to_array("rawPrediction"))
        added = F.when(F.col("votes").isNull(), F.col("raw")).otherwise(F.zip_with("votes", "raw", lambda a, b: a + b))
        rows = materialize(voted.select("label_idx", "features", added.alias("votes")))
    first = (F.array_position("votes", F.array_max("votes")) - 1).cast("double")
    return metrics.accuracy_of(rows.withColumn("prediction", first), "label_idx", "prediction")


def node_table(model: RandomForestClassificationModel) -> DataFrame:
    """Nodes of a fitted forest, written and read as its export does."""
    spark = SparkSession.active()
    path = shared_folder(spark)
    model.write().overwrite().save(path)
    return materialize(forests.nodes_of_model(spark, path))


def prefix_accuracies(rows: DataFrame, nodes: DataFrame, sizes: Sequence[int], depths: Sequence[int] | None = None) -> list[float]:
    """Accuracy of the first trees for every size, and with ``depths`` of the trees cut at each of them (depth by depth)."""
    n_classes = len(nodes.select("value").first()["value"])
    dense = rows.select("label_idx", vector_to_array("features").alias("x"))
    scored = forests.score_prefixes(dense, nodes, n_classes, "x", sizes, depths)
    blocks = len(sizes) * (len(depths) if depths else 1)
    hits = [F.avg((F.get("predictions", F.lit(i)) == F.col("label_idx")).cast("double")).alias(f"a{i}") for i in range(blocks)]
    return [float(a or 0.0) for a in scored.agg(*hits).first()]


def forest_cross_validation(rows: DataFrame, fold: str = "fold", n_folds: int = 5,
                            trees: Sequence[int] = CV_TREES, depths: Sequence[int] = CV_DEPTHS,
                            min_leaf: Sequence[int] = CV_MIN_LEAF, seed: int = 42,
                            parallelism: int = 4) -> tuple[Model | grove.GrownForest, DataFrame]:
    """Mean accuracy over the given folds per setting, and the best one refitted (the first on ties).

    A fold and a smallest part take one fit, of the most trees and the largest depth: smaller forests are its first trees,
    shallower ones its trees cut at a depth, as a node keeps the class weights that a leaf in its place would have. So a
    grid of 5 sizes, 5 depths and 4 smallest parts takes 20 fits over 5 folds, ``parallelism`` at a time. Where the trees of all
    fits may come to more than ``GROWN_AT_ONCE`` nodes they are grown in tasks (``grove``), and the best forest, if it may too,
    is grown when it predicts."""
    by_depth = sorted(set(depths))

    def one(task: tuple[int, int]) -> tuple[tuple[int, int], list[float]]:
        leaf, k = task
        nodes = node_table(forest(max(trees), by_depth[-1], leaf, seed).fit(rows.filter(F.col(fold) != k)))
        return task, prefix_accuracies(rows.filter(F.col(fold) == k), nodes, trees, by_depth)
    tasks = [(leaf, k) for leaf in dict.fromkeys(min_leaf) for k in range(n_folds)]
    n_rows = rows.count()
    in_tasks = len(tasks) * most_nodes(n_rows, max(trees), by_depth[-1]) > GROWN_AT_ONCE and n_folds < 256 and grove.fits(rows, n_rows, n_folds)
    if in_tasks:
        found = _grown_folds(rows, fold, n_folds, trees, by_depth, tasks, seed)
    else:
        with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
            found = dict(pool.map(inheritable_thread_target(rows.sparkSession)(one), tasks))
    out = []
    for i, (d, leaf, n) in enumerate(product(depths, min_leaf, trees)):
        at = by_depth.index(d) * len(trees) + list(trees).index(n)
        out.append((i, n, d, leaf, sum(found[leaf, k][at] for k in range(n_folds)) / n_folds))
    best = max(out, key=lambda r: (r[-1], -r[0]))
    learner = forest(best[1], best[2], best[3], seed)
    grown = in_tasks and most_nodes(n_rows, best[1], best[2]) > GROWN_AT_ONCE and grove.fits(rows, n_rows)
    model = grove.GrownForest(rows, best[1], best[2], best[3], seed) if grown else learner.fit(rows)
    return model, _rows(rows, out, "position int, trees int, depth int, min_leaf int, accuracy double")


def _grown_folds(rows: DataFrame, fold: str, n_folds: int, trees: Sequence[int], depths: Sequence[int],
                 tasks: Sequence[tuple[int, int]], seed: int) -> dict[tuple[int, int], list[float]]:
    """Accuracy on its fold of every smallest part and fold, depth by depth and within one by size; a fold has thresholds of its own."""
    # Rows outside the folds always train; those without a fold never do.
    known = rows.filter(F.col(fold).isNotNull()).select(
        "label_idx", "features", fold, F.when(F.col(fold).between(0, n_folds - 1), F.col(fold)).otherwise(n_folds).alias("part")).persist()
    tables = []
    for k in range(n_folds):
        train = known.filter(F.col("part") != k)
        tables.append(grove.held(known, grove.thresholds(train, train.count())))
    jobs = []
    for leaf, k in tasks:
        learner = forest(max(trees), depths[-1], leaf, seed)
        others = tuple(p for p in range(n_folds + 1) if p != k)
        jobs.append(grove.Growth(k, others, (k,), learner.getNumTrees(), learner.getMaxDepth(), learner.getMinInstancesPerNode(), seed))
    found = grove.grown_accuracies(rows.sparkSession, tables, jobs, trees, depths)
    known.unpersist()
    return {task: [found[i, task[1], n, d] for d in depths for n in trees] for i, task in enumerate(tasks)}


def learning_curve(train: DataFrame, val: DataFrame, n_features: int, n_classes: int,
                   hidden: Sequence[int] = (256, 128), epochs: int = 25, seed: int = 311) -> DataFrame:
    """Accuracy after each warm-started step of the perceptron."""
    out, weights = [], None
    for epoch in range(1, epochs + 1):
        learner = perceptron(n_features, n_classes, hidden, 1, seed)
        if weights is not None:
            learner = learner.setInitialWeights(weights)
        model = learner.fit(train)
        weights = model.weights
        out.append((epoch, accuracy(model, train), accuracy(model, val)))
    return _rows(train, out, "epoch int, train_accuracy double, val_accuracy double")


def layer_table(model: Model, df: DataFrame) -> DataFrame:
    """Perceptron weights as ``layer, w, b``; the size is fixed by the layers."""
    flat = [float(x) for x in model.weights.toArray()]
    sizes = model.getLayers()
    out, at = [], 0
    for i, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        # One layer after the other; in each, weights by input, then the biases.
        w = [[flat[at + r + c * n_out] for r in range(n_out)] for c in range(n_in)]
        at += n_in * n_out
        out.append((i + 1, w, flat[at:at + n_out]))
        at += n_out
    return _rows(df, out, "layer int, w array<array<double>>, b array<double>")


def score_layers(df: DataFrame, layers: DataFrame, features: str, hidden: str = "relu") -> DataFrame:
    """Add ``probability`` (softmax of the last layer) and ``prediction`` (its first largest place) from saved layers.

    ``layers`` is a table ``layer, w, b`` as ``layer_table`` gives it: ``w`` has a row per input. The layers between are followed
    by ``hidden``: ``relu`` or ``sigmoid``. ``features`` is an ``array<double>`` column as wide as the first layer; a batch of
    rows is one matrix product per layer. A null array gives null. The table must fit ``LAYER_BYTES``."""
    if hidden not in ("relu", "sigmoid"):
        raise ValueError(f"no hidden function {hidden!r}")
    size = layers.agg(F.coalesce(F.sum(F.aggregate("w", F.lit(0).cast("bigint"), lambda a, r: a + F.size(r)) * 8), F.lit(0)).alias("bytes")).first()
    if size["bytes"] > LAYER_BYTES:
        raise ValueError(f"layers of more than {LAYER_BYTES} bytes cannot be broadcast")
    held = [(np.array(r["w"], np.float64), np.array(r["b"], np.float64)) for r in layers.orderBy("layer").collect()]
    shared = df.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("array<double>")
    def forward(column: pd.Series) -> pd.Series:
        given = column.notna().to_numpy()
        out: list = [None] * len(column)
        if given.any():
            x = np.stack(column[given].to_numpy()).astype(np.float64)
            for i, (w, b) in enumerate(shared.value):
                x = x @ w + b
                if i < len(shared.value) - 1:
                    x = np.maximum(x, 0.0) if hidden == "relu" else 1.0 / (1.0 + np.exp(-x))
            x = np.exp(x - x.max(axis=1, keepdims=True))
            for at, row in zip(np.flatnonzero(given), x / x.sum(axis=1, keepdims=True)):
                out[at] = row
        return pd.Series(out, dtype=object)
    scored = df.withColumn("probability", forward(F.col(features).cast("array<double>")))
    return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("int"))


def compare(models: dict[str, Callable[[DataFrame, DataFrame], float]], train: DataFrame,
            val: DataFrame) -> DataFrame:
    """Validation accuracy of several fitted-and-scored models."""
    return _rows(train, [(i, name, run(train, val)) for i, (name, run) in enumerate(models.items())],
                 "position int, model string, val_accuracy double")
