"""Fitted steps for ratings and multi-select answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.options import options_among
from ..functions.ratings import rating, scaled_rating
from .records import quoted


def rating_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Most frequent rating per column, the smallest on ties."""
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("q"), rating(F.col(quoted(c))).alias("r"))
        for i, c in enumerate(cols)])).alias("x")).select("x.q", "x.r")
    counts = values.filter(F.col("r").isNotNull()).groupBy("q", "r").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("q").agg(F.max(F.struct("n", (-F.col("r")).alias("neg"))).alias("b"))
    modes = {cols[r["q"]]: -r["neg"] for r in best.select("q", "b.neg").collect()}  # one row per column
    for c in cols:
        if c not in modes:
            raise ValueError(f"column {c!r} has no rating")
    return modes


def imputed_rating(c: str, modes: Mapping[str, int]) -> Column:
    return rating(F.col(quoted(c)), modes[c])


def impute_ratings(df: DataFrame, cols: Sequence[str], modes: Mapping[str, int] | None = None,
                   scale: bool = False) -> DataFrame:
    """Replace rating columns by numbers, missing ones by the mode.

    ``modes=None`` takes the modes of ``df`` itself; pass the modes of the
    training rows to keep a held-out part out of the fit.
    """
    modes = rating_modes(df, cols) if modes is None else modes
    values = {c: imputed_rating(c, modes) for c in cols}
    return df.withColumns({c: scaled_rating(v) if scale else v for c, v in values.items()})


def learned_options(df: DataFrame, selected: Column) -> list[str]:
    """Options that occur, sorted; the parse rules bound their number."""
    rows = df.select(F.explode_outer(selected).alias("o")).filter("o IS NOT NULL").distinct().collect()
    return sorted(r["o"] for r in rows)


def target_options(df: DataFrame, col: str, targets: Sequence[str]) -> list[str]:
    return learned_options(df, options_among(F.col(quoted(col)), targets))
