"""Splits and folds.

Each split finds a few exact cut values first (ranks of a seeded digest or of
an order key) and then labels the rows with plain comparisons, so the data
itself is neither sorted nor shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import POSITION_CUTS
from .distribute import hash_cutoffs, hash_order, materialize, order_cutoffs

SPLITS = ("train", "val", "test")


def _by_cut(value: str, cuts: Sequence, names: Sequence) -> Column:
    """Name of the interval a value lies in; a cut is the last value of its part."""
    label = F.when(F.lit(False), F.lit(names[0]))
    for cut, name in zip(cuts, names):
        if cut is not None:
            label = label.when(F.col(value) <= F.lit(cut), F.lit(name))
    return label.otherwise(F.lit(names[len(cuts)]))


def ratio_cuts(n: int, ratios: Sequence[float]) -> list[int]:
    """Cumulative part sizes ``int(n * ratio)``; the rest is the last part."""
    ends, at = [], 0
    for r in ratios:
        at += int(n * r)
        ends.append(at)
    return ends


def split_by_position(df: DataFrame, key: str, cuts: Sequence[int] = POSITION_CUTS,
                      names: Sequence[str] = SPLITS, ratios: Sequence[float] | None = None,
                      out: str = "split") -> DataFrame:
    """Cut the rows, in the order of the unique ``key``, at absolute positions."""
    if ratios is not None:
        cuts = ratio_cuts(df.count(), ratios)
    at = order_cutoffs(df, key, cuts)
    past = [c for c in cuts if c >= 1 and c not in at]
    last = df.agg(F.max(key).alias("m")).first()["m"] if past else None  # a part that takes all the rest
    values = [at.get(c, last) if c >= 1 else None for c in cuts]
    return df.withColumn(out, _by_cut(key, values, names))


def split_shuffled(df: DataFrame, key: str, cuts: Sequence[int] = POSITION_CUTS,
                   names: Sequence[str] = SPLITS, seed: int = 42,
                   ratios: Sequence[float] | None = None, out: str = "split") -> DataFrame:
    """As ``split_by_position`` after a seeded shuffle of the rows."""
    rows = df.withColumn("_h", hash_order(key, seed))
    if ratios is not None:
        cuts = ratio_cuts(df.count(), ratios)
    found = hash_cutoffs(rows, "_h", {None: cuts})
    # A cut past the end keeps everything: "g" sorts after every hex digest.
    values = [found.get((None, c), "g") if c >= 1 else None for c in cuts]
    return rows.withColumn(out, _by_cut("_h", values, names)).drop("_h")


def split_by_group(df: DataFrame, group: str, ratios: Sequence[float] = (0.7, 0.15),
                   names: Sequence[str] = SPLITS, seed: int = 666, out: str = "split") -> DataFrame:
    """Split whole groups; no group is spread over two parts. The rows without a group are one group."""
    groups = materialize(df.select(group).distinct().withColumn("_h", hash_order(group, seed)))
    cuts = ratio_cuts(groups.count(), ratios)
    found = hash_cutoffs(groups, "_h", {None: cuts})
    values = [found.get((None, c)) if c >= 1 else None for c in cuts]
    return (df.withColumn("_h", hash_order(group, seed))
            .withColumn(out, _by_cut("_h", values, names)).drop("_h"))


def class_sizes(df: DataFrame, label: str) -> list[tuple[str, int]]:
    """Classes in order with their sizes; one row per class."""
    rows = df.groupBy(F.col(label).cast("string").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["g"], r["n"]) for r in rows.collect() if r["g"] is not None)


def stratified_sizes(sizes: Sequence[tuple[str, int]], test_size: float) -> dict[str, int]:
    """Test rows per class: ceil(n * test_size) in all, by largest remainder."""
    n = sum(s for _, s in sizes)
    n_train = n - ceil(round(n * test_size, 9))
    exact = {g: s * n_train / n for g, s in sizes}
    take = {g: int(e) for g, e in exact.items()}
    missing = n_train - sum(take.values())
    for g in sorted(exact, key=lambda g: (-(round(exact[g] - take[g], 9)), g))[:missing]:
        take[g] += 1
    return {g: s - take[g] for g, s in sizes}


def _label_by_class(rows: DataFrame, label: str, found: dict, per_class: dict[str, list],
                    names: Sequence, out: str) -> DataFrame:
    """Attach the cut digests of the row's class and compare."""
    spark = rows.sparkSession
    width = len(names) - 1
    # One local row per class; the planner broadcasts it if small enough.
    cut_rows = [(g, [found.get((g, c)) if c >= 1 else "" for c in cuts])
                for g, cuts in per_class.items()]
    cuts = spark.createDataFrame(cut_rows, "_g string, _cuts array<string>")
    label_of = F.when(F.lit(False), F.lit(names[0]))
    for i in range(width):
        label_of = label_of.when(F.col("_h") <= F.get("_cuts", F.lit(i)), F.lit(names[i]))
    return (rows.join(cuts, F.col(label).cast("string") == F.col("_g"))
            .withColumn(out, label_of.otherwise(F.lit(names[width])))
            .drop("_h", "_g", "_cuts"))


def split_stratified(df: DataFrame, key: str, label: str, test_size: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Two parts with the class shares of the whole; rows without label are dropped."""
    rows = df.filter(F.col(label).isNotNull()).withColumn("_h", hash_order(key, seed))
    test = stratified_sizes(class_sizes(rows, label), test_size)
    per_class = {g: [n] for g, n in test.items()}
    found = hash_cutoffs(rows, "_h", per_class, by=label)
    return _label_by_class(rows, label, found, per_class, ("val", "train"), out)


def kfold(df: DataFrame, key: str, n_folds: int = 5, seed: int = 42,
          out: str = "fold") -> DataFrame:
    """Shuffled folds; the first ``n % n_folds`` folds hold one row more."""
    rows = df.withColumn("_h", hash_order(key, seed))
    n = df.count()
    ends, at = [], 0
    for i in range(n_folds - 1):
        at += n // n_folds + (1 if i < n % n_folds else 0)
        ends.append(at)
    found = hash_cutoffs(rows, "_h", {None: ends})
    values = [found.get((None, e)) if e >= 1 else None for e in ends]
    return rows.withColumn(out, _by_cut("_h", values, list(range(n_folds)))).drop("_h")


def kfold_stratified(df: DataFrame, key: str, label: str, n_folds: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Folds that keep class shares; both fold and class-in-fold sizes differ by at most 1.

    The classes are laid end to end and dealt to the folds in turn, which fixes
    how many rows of a class go to each fold; the rows follow digest order.
    """
    rows = df.filter(F.col(label).isNotNull()).withColumn("_h", hash_order(key, seed))
    per_class, start = {}, 0
    for g, n in class_sizes(rows, label):
        ends, at = [], 0
        for i in range(n_folds - 1):
            first = (i - start) % n_folds
            at += (n - first + n_folds - 1) // n_folds if n > first else 0
            ends.append(at)
        per_class[g] = ends
        start += n
    found = hash_cutoffs(rows, "_h", per_class, by=label)
    return _label_by_class(rows, label, found, per_class, list(range(n_folds)), out)


def train_and_val(df: DataFrame, split: str = "split") -> DataFrame:
    """Bag union of the train and validation parts, for a refit."""
    train = df.filter(F.col(split) == "train")
    val = df.filter(F.col(split) == "val")
    return train.unionByName(val)
