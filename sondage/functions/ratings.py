"""Rating expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import DEFAULT_RATING, RATING_LEVELS
from .text import _col


def rating(c: str | Column, default: int | None = None) -> Column:
    """Whole number (bigint) at the very start of the cell, or ``default``; one that no bigint holds is missing."""
    digits = F.regexp_extract(_col(c).cast("string"), r"^(\p{Nd}+)", 1)
    value = F.nullif(digits, F.lit("")).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def rating_or_middle(c: str | Column) -> Column:
    return rating(c, DEFAULT_RATING)


def scaled_rating(value: Column) -> Column:
    """Map 1..5 to 0..1 without clamping."""
    return (value - F.lit(1.0)) / F.lit(4.0)


def one_hot(value: Column, levels: Sequence[int] = RATING_LEVELS) -> Column:
    """``array<double>`` with one place per level; all zero for other values."""
    return F.array(*[F.coalesce((value == k).cast("double"), F.lit(0.0)) for k in levels])
