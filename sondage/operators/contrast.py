"""Differences between the responses of two labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import OPTIONS, SHORT_STOP
from ..functions.ratings import rating
from ..functions.text import tokens
from .distribute import materialize
from .records import keep_labels, quoted


def rating_stats(df: DataFrame, label: str, labels: Sequence, cols: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and count of the given ratings, per question and label."""
    rows = keep_labels(df, labels, label).select(label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("question"), rating(F.col(quoted(c))).alias("r")) for c in cols])).alias("x"))
    return (rows.select(label, "x.question", "x.r").filter(F.col("r").isNotNull())
            .groupBy("question", label)
            .agg(F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"), F.count("r").alias("n")))


def length_stats(df: DataFrame, label: str, labels: Sequence, cols: Sequence[str],
                 stop: Sequence[str] | None = SHORT_STOP) -> DataFrame:
    """Mean, sample deviation and count of text lengths; a missing text has length 0."""
    rows = keep_labels(df, labels, label).select(label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("question"), F.size(tokens(F.col(quoted(c)), stop)).alias("len"))
        for c in cols])).alias("x"))
    return (rows.select(label, "x.question", "x.len").groupBy("question", label)
            .agg(F.avg("len").alias("mean"), F.stddev_samp("len").alias("std"),
                 F.count(F.lit(1)).alias("n")))


def option_rates(df: DataFrame, label: str, a, b, selected: Column,
                 options: Sequence[str] = OPTIONS) -> DataFrame:
    """Share of answers with an option among those that chose any, per label.

    One aggregation counts all options side by side; every option is listed.
    """
    rows = keep_labels(df, (a, b), label).select(F.col(label).alias("_l"), selected.alias("_s"))

    def count_if(value, condition: Column) -> Column:
        return F.coalesce(F.sum(((F.col("_l") == value) & condition).cast("long")), F.lit(0))

    answered = F.size("_s") > 0
    sums = rows.agg(
        count_if(a, answered).alias("na"), count_if(b, answered).alias("nb"),
        *[count_if(a, F.array_contains("_s", o)).alias(f"a{i}") for i, o in enumerate(options)],
        *[count_if(b, F.array_contains("_s", o)).alias(f"b{i}") for i, o in enumerate(options)])

    def share(count: str, total: str) -> Column:
        return F.coalesce(F.try_divide(F.col(count).cast("double"), F.col(total).cast("double")), F.lit(0.0))

    table = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(o).alias("option"),
                               share(f"a{i}", "na").alias("rate_a"), share(f"b{i}", "nb").alias("rate_b"))
                      for i, o in enumerate(options)])
    return sums.select(F.inline(table)).withColumn("diff", F.col("rate_a") - F.col("rate_b"))


def top_options(rates: DataFrame, n: int = 5) -> DataFrame:
    """Options with the largest absolute difference; ties in option order."""
    return rates.orderBy(F.round(F.abs("diff"), 9).desc(), "idx").limit(n)


def keyword_contrast(terms: DataFrame, label: str, a, b, min_count: int = 5) -> DataFrame:
    """Relative frequency of each word per label, and the difference.

    The share is of all words of the label; rare words (fewer than
    ``min_count`` in both together) are left out afterwards. ``terms`` is a
    term table that kept ``label``.
    """
    def tf_if(value) -> Column:
        return F.coalesce(F.sum(F.when(F.col(label) == value, F.col("tf"))), F.lit(0))

    # One row per word; read twice, for the totals and for the shares.
    counts = materialize(keep_labels(terms, (a, b), label).groupBy("term")
                         .agg(tf_if(a).alias("n_a"), tf_if(b).alias("n_b")))
    totals = counts.agg(F.sum("n_a").alias("a"), F.sum("n_b").alias("b")).first()

    def share(n: str, total: str) -> Column:
        whole = F.lit(float(totals[total] or 0))
        return F.coalesce(F.try_divide(F.col(n).cast("double"), whole), F.lit(0.0))

    return (counts.filter(F.col("n_a") + F.col("n_b") >= min_count)
            .select("term", "n_a", "n_b", share("n_a", "a").alias("freq_a"), share("n_b", "b").alias("freq_b"))
            .withColumn("diff", F.col("freq_a") - F.col("freq_b")))


def top_keywords(contrast: DataFrame, n: int = 20, a: str = "a", b: str = "b") -> DataFrame:
    """The words most preferred by each side; ties by word."""
    diff = F.round("diff", 12)
    return (contrast.orderBy(diff.desc(), "term").limit(n).withColumn("side", F.lit(a))
            .unionByName(contrast.orderBy(diff.asc(), "term").limit(n).withColumn("side", F.lit(b))))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
