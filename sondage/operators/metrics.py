"""Evaluation of predictions. Everything follows from the counts per
(true, predicted) pair, one small aggregation of the rows. Reports that read the
counts more than once compute them once (at most classes x classes rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .distribute import pin


def pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return (df.groupBy(F.col(y).cast("string").alias("y"), F.col(p).cast("string").alias("p"))
            .agg(F.count(F.lit(1)).alias("n")))


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def accuracy_of(df: DataFrame, y: str, p: str) -> float:
    return accuracy(df, y, p).first()["accuracy"]


def class_scores(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as truth or prediction;
    an empty denominator gives 0."""
    sides = pairs.select(*by, F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hit")))).alias("s"))
    sums = sides.groupBy(*by, F.col("s.c").alias("class")).agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hit").alias("hit"))

    def ratio(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

    return sums.select(*by, "class", ratio(F.col("hit"), F.col("predicted")).alias("precision"),
                       ratio(F.col("hit"), F.col("support")).alias("recall"),
                       ratio(F.col("hit") * 2, F.col("predicted") + F.col("support")).alias("f1"),
                       "support", "hit")


def macro_f1(df: DataFrame, y: str, p: str) -> DataFrame:
    return class_scores(pair_counts(df, y, p)).agg(F.avg("f1").alias("macro_f1"))


def weighted_f1(df: DataFrame, y: str, p: str) -> DataFrame:
    scores = class_scores(pair_counts(df, y, p))
    return scores.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row per class, then accuracy, macro and weighted averages."""
    scores = class_scores(pin(pair_counts(df, y, p)))
    rows = scores.select("class", "precision", "recall", "f1", "support")
    total = F.sum("support")

    def weighted(c: str):
        return F.sum(F.col(c) * F.col("support")) / total

    names = ("precision", "recall", "f1")
    whole = scores.agg((F.sum("hit") / total).alias("acc"), total.alias("support"),
                       *[F.avg(c).alias(f"m_{c}") for c in names], *[weighted(c).alias(f"w_{c}") for c in names])
    table = F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("acc").alias("precision"),
                 F.col("acc").alias("recall"), F.col("acc").alias("f1"), F.col("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"m_{c}").alias(c) for c in names], F.col("support")),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"w_{c}").alias(c) for c in names], F.col("support")))
    return rows.unionByName(whole.select(F.inline(table)))


def summary_metrics(df: DataFrame, y: str, p: str) -> dict[str, float]:
    """Accuracy, macro and weighted F1 from one pass."""
    s = class_scores(pair_counts(df, y, p)).agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted")).first()
    return s.asDict()


def confusion_matrix(df: DataFrame, y: str, p: str, true_labels_only: bool = False) -> DataFrame:
    """Count of every (true, predicted) class combination, zeros included.

    The class list is one array, so the grid has classes x classes rows.
    """
    pairs = pin(pair_counts(df, y, p))
    listed = [F.col("y")] if true_labels_only else [F.col("y"), F.col("p")]
    classes = (pairs.select(F.explode(F.array(*listed)).alias("c"))
               .agg(F.array_sort(F.collect_set("c")).alias("all")))
    grid = classes.select("all", F.explode("all").alias("y")).select("y", F.explode("all").alias("p"))
    return grid.join(pairs, ["y", "p"], "left").select("y", "p", F.coalesce("n", F.lit(0)).alias("n"))


def error_pairs(df: DataFrame, y: str, p: str, top: int = 10) -> DataFrame:
    """The most frequent wrong (true, predicted) pairs."""
    wrong = pair_counts(df, y, p).filter(F.col("y") != F.col("p"))
    return wrong.orderBy(F.desc("n"), "y", "p").limit(top)


def usual_confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """Most frequent wrong prediction of each true label; labels without error are listed."""
    pairs = pin(pair_counts(df, y, p))
    wrong = (pairs.filter(F.col("y") != F.col("p"))
             .withColumn("rk", F.row_number().over(Window.partitionBy("y").orderBy(F.desc("n"), "p")))
             .filter(F.col("rk") == 1).select("y", "p", "n"))
    return pairs.select("y").distinct().join(wrong, "y", "left")


def best_setting(metrics: DataFrame, metric: str, position: str) -> DataFrame:
    """First setting, in grid order, that reaches the best value."""
    return metrics.orderBy(F.round(metric, 9).desc(), position).limit(1)
