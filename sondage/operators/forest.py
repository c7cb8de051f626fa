"""Forests as node tables: export, import and scoring.

``tree_id, node_id, left, right, feature, threshold, value array<double>``; a leaf
has ``left = -1``. ``value`` holds the class weights of the node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .distribute import lookup_join, materialize

NODES_PER_PASS = 500_000
NODES_AT_MOST = 10_000_000  # of a forest; some hundred bytes each pass through the driver's memory


def nodes_of_model(spark: SparkSession, model_path: str) -> DataFrame:
    """Node table of a forest saved by Spark ML."""
    n = F.col("nodeData")
    return spark.read.parquet(f"{model_path}/data").select(
        F.col("treeID").cast("int").alias("tree_id"), n["id"].alias("node_id"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["impurityStats"].alias("value"))


def nodes_of_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Node table of an exported forest.

    Reads one JSON document with parallel arrays per tree, or, as written by
    ``write_forest_json``, one tree per line with its ``tree_id``. An indented
    document needs ``multiline``.
    """
    arrays = ("children_left array<int>, children_right array<int>, feature array<int>, "
              "threshold array<double>, value array<array<double>>")
    line = spark.read.schema(f"tree_id int, {arrays}, trees array<struct<{arrays}>>").option(
        "multiLine", multiline).json(path)
    names = ("children_left", "children_right", "feature", "threshold", "value")
    listed = line.filter(F.col("trees").isNotNull()).select(F.posexplode("trees").alias("tree_id", "t"))
    single = line.filter(F.col("trees").isNull()).select("tree_id", F.struct(*names).alias("t"))
    nodes = listed.unionByName(single).select("tree_id", F.posexplode(F.arrays_zip(
        *[F.col("t")[n].alias(n) for n in names])).alias("node_id", "n"))
    return nodes.select("tree_id", "node_id", F.col("n.children_left").alias("left"),
                        F.col("n.children_right").alias("right"), F.col("n.feature").alias("feature"),
                        F.col("n.threshold").alias("threshold"), F.col("n.value").alias("value"))


def write_forest_json(nodes: DataFrame, path: str) -> None:
    """One line per tree with parallel node arrays; a tree is bounded by its depth."""
    ordered = F.array_sort(F.collect_list(F.struct(
        "node_id", "left", "right", "feature", "threshold", "value")))
    trees = nodes.groupBy("tree_id").agg(ordered.alias("n"))
    trees.select("tree_id", F.size("n").alias("node_count"), F.col("n.left").alias("children_left"),
                 F.col("n.right").alias("children_right"), F.col("n.feature").alias("feature"),
                 F.col("n.threshold").alias("threshold"), F.col("n.value").alias("value")
                 ).repartition("tree_id").write.mode("overwrite").json(path)


class _Descent:
    """All trees of one pass as flat arrays; rows walk all trees side by side. Shares are summed over the trees with an
    id below each of ``sizes`` (None: over all), and over trees cut at each of ``depths`` (None: grown as they are)."""

    def __init__(self, nodes: pd.DataFrame) -> None:
        nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        place = {key: i for i, key in enumerate(zip(nodes["tree_id"], nodes["node_id"]))}
        trees = nodes["tree_id"].to_numpy()

        def child(column: str) -> np.ndarray:
            return np.array([place[t, c] if c >= 0 else -1 for t, c in zip(trees, nodes[column])], dtype=np.int64)

        self.left, self.right = child("left"), child("right")
        self.feature = np.where(self.left >= 0, nodes["feature"].to_numpy(), 0)
        self.threshold = nodes["threshold"].to_numpy(dtype=np.float64)
        value = np.array(nodes["value"].tolist(), dtype=np.float64)
        self.share = value / value.sum(axis=1, keepdims=True)
        self.trees = np.unique(trees)
        self.roots = np.array([place[t, 0] for t in self.trees], dtype=np.int64)

    def _summed(self, at: np.ndarray, sizes: Sequence[int] | None) -> list[np.ndarray]:
        share = self.share[at]
        return [share[:, self.trees < s].sum(axis=1) for s in sizes] if sizes else [share.sum(axis=1)]

    def total(self, n: int, feature_values, sizes: Sequence[int] | None = None, depths: Sequence[int] | None = None) -> np.ndarray:
        """Sum over the trees of the class shares of the reached leaf, for ``n`` rows; ``feature_values`` gives the value of
        feature ``f[i, j]`` of row i. One block of classes per size, within one per depth."""
        at = np.tile(self.roots, (n, 1))
        out, level = [], 0
        waiting = list(depths or ())
        while True:
            while waiting and waiting[0] == level:
                out += self._summed(at, sizes)
                waiting.pop(0)
            inner = self.left[at] >= 0
            if not inner.any() or (depths and not waiting):
                for _ in (waiting if depths else [None]):
                    out += self._summed(at, sizes)
                return np.concatenate(out, axis=1)
            goes_left = feature_values(self.feature[at]) <= self.threshold[at]
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            level += 1


def _of_dense(x: np.ndarray):
    rows = np.arange(len(x))[:, None]
    return lambda features: x[rows, features]


def _of_sparse(idx: Sequence[np.ndarray], value: Sequence[np.ndarray], width: int):
    """Values of sparse rows (ascending indexes below ``width``), zero where a row has none."""
    sizes = np.array([len(i) for i in idx], np.int64)
    keys = np.repeat(np.arange(len(idx), dtype=np.int64), sizes) * width + np.concatenate([*idx, np.zeros(0, np.int64)]).astype(np.int64)
    held = np.concatenate([*value, np.zeros(1)])  # the last one is for places past the end
    rows = np.arange(len(idx), dtype=np.int64)[:, None] * width

    def values(features: np.ndarray) -> np.ndarray:
        wanted = rows + features
        place = np.searchsorted(keys, wanted)
        there = np.append(keys, -1)[place] == wanted
        return np.where(there, held[place], 0.0)
    return values


def _passes(nodes: DataFrame, limit: int) -> list[list[int]]:
    """Tree ids, grouped so that each group has at most ``limit`` nodes."""
    sizes = sorted((r["tree_id"], r["n"]) for r in
                   nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).collect())
    if sum(n for _, n in sizes) > NODES_AT_MOST:
        raise ValueError(f"a forest of more than {NODES_AT_MOST} nodes cannot be broadcast")
    groups: list[list[int]] = []
    held = limit
    for tree, n in sizes:
        if held + n > limit or not groups:
            groups.append([])
            held = 0
        groups[-1].append(tree)
        held += n
    return groups


def _leaf_shares(shared, batch: int, sizes: Sequence[int] | None = None, depths: Sequence[int] | None = None):
    @F.pandas_udf("array<double>")
    def shares(cells: Iterator[pd.Series]) -> Iterator[pd.Series]:
        descent = None
        for column in cells:
            descent = descent or _Descent(shared.value)
            out: list = []
            for at in range(0, len(column), batch):
                x = np.stack(column[at:at + batch].to_numpy())
                out.extend(descent.total(len(x), _of_dense(x), sizes, depths))
            yield pd.Series(out, dtype=object)
    return shares


def _sparse_shares(shared, width: int, batch: int):
    @F.pandas_udf("array<double>")
    def shares(cells: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        descent = None
        for idx, value in cells:
            descent = descent or _Descent(shared.value)
            out: list = []
            for at in range(0, len(idx), batch):
                i, v = idx[at:at + batch].to_list(), value[at:at + batch].to_list()
                out.extend(descent.total(len(i), _of_sparse(i, v, width)))
            yield pd.Series(out, dtype=object)
    return shares


def _summed_over_passes(context, nodes: DataFrame, nodes_per_pass: int, shares) -> tuple[Column, int]:
    """Sum of ``shares(broadcast nodes)`` over passes of whole trees, and the number of trees."""
    groups = _passes(nodes, nodes_per_pass)
    total = None
    for group in groups:
        this = shares(context.broadcast(nodes.filter(F.col("tree_id").isin(group)).toPandas()))
        total = this if total is None else F.zip_with(total, this, lambda a, b: a + b)
    return total, sum(len(g) for g in groups)


def _with_prediction(df: DataFrame, total: Column, n_trees: int, classes: Sequence[str]) -> DataFrame:
    scored = df.withColumn("probability", F.transform(total, lambda s: s / F.lit(float(n_trees))))
    best = F.array_position("probability", F.array_max("probability")).cast("int")
    return scored.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in classes]), best))


def score_forest(df: DataFrame, nodes: DataFrame, classes: Sequence[str], features: str,
                 nodes_per_pass: int = NODES_PER_PASS, batch: int = 2048) -> DataFrame:
    """Add ``probability`` (mean leaf share per class) and ``prediction``.

    ``features`` is a dense ``array<double>`` column. The nodes of a pass are
    broadcast; a larger forest takes several passes of whole trees, and one of more
    than ``NODES_AT_MOST`` nodes is refused. Ties go to the first class.
    """
    total, n_trees = _summed_over_passes(
        df.sparkSession.sparkContext, nodes, nodes_per_pass,
        lambda shared: _leaf_shares(shared, batch)(F.col(features).cast("array<double>")))
    return _with_prediction(df, total, n_trees, classes)


def score_sparse(rows: DataFrame, features: DataFrame, nodes: DataFrame, classes: Sequence[str],
                 nodes_per_pass: int = NODES_PER_PASS, batch: int = 2048) -> DataFrame:
    """As ``score_forest`` for ``rows`` (unique ``row_id``) whose features are a long table ``row_id, idx, value``.

    Only features that a node asks for are kept, by a join with the (at most ``NODES_AT_MOST``) asked ones; the trees
    walk what is left of a row, so that its width is that of the forest and not that of the layout. A row without any
    of them has only zeros."""
    inner = nodes.filter(F.col("left") >= 0)
    asked = materialize(inner.select(F.col("feature").cast("bigint").alias("idx")).distinct())
    width = (asked.agg(F.max("idx").alias("m")).first()["m"] or 0) + 1
    known = lookup_join(features.select("row_id", "idx", "value"), asked, ["idx"], "row_id")
    packed = known.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("f"))
    held = rows.join(packed.select("row_id", F.col("f.idx").alias("_idx"), F.col("f.value").cast("array<double>").alias("_value")), "row_id", "left")
    held = held.withColumns({"_idx": F.coalesce("_idx", F.array().cast("array<bigint>")), "_value": F.coalesce("_value", F.array().cast("array<double>"))})
    total, n_trees = _summed_over_passes(
        rows.sparkSession.sparkContext, nodes, nodes_per_pass, lambda shared: _sparse_shares(shared, width, batch)("_idx", "_value"))
    return _with_prediction(held, total, n_trees, classes).drop("_idx", "_value")


def score_prefixes(df: DataFrame, nodes: DataFrame, n_classes: int, features: str, sizes: Sequence[int],
                   depths: Sequence[int] | None = None, nodes_per_pass: int = NODES_PER_PASS, batch: int = 512) -> DataFrame:
    """Add ``predictions``: the class index that the first ``s`` trees vote for, for every ``s`` of ``sizes``; with
    ascending ``depths`` for the trees cut at each of them, depth by depth. One walk gives them all."""
    total, _ = _summed_over_passes(
        df.sparkSession.sparkContext, nodes, nodes_per_pass,
        lambda shared: _leaf_shares(shared, batch, list(sizes), list(depths) if depths else None)(F.col(features).cast("array<double>")))
    blocks = len(sizes) * (len(depths) if depths else 1)

    def winner(totals: Column, i: int) -> Column:
        part = F.slice(totals, i * n_classes + 1, n_classes)
        return (F.array_position(part, F.array_max(part)) - 1).cast("int")
    return df.withColumn("_totals", total).withColumn(
        "predictions", F.array(*[winner(F.col("_totals"), i) for i in range(blocks)])).drop("_totals")
