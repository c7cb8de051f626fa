"""Multi-select answers: parse a cell to options, then to 0/1 features."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import BASELINE_TARGETS, OPTION_RULES, OPTIONS
from .text import _col, empty_strings

Rules = Sequence[tuple[str, str]]


def options_by_part(c: str | Column, rules: Rules = OPTION_RULES) -> Column:
    """Split at commas; each part gives the first rule it contains. Sorted set."""
    cell = F.translate(_col(c).cast("string"), "\r\n", "  ")

    def first_rule(part: Column) -> Column:
        hit = F.when(F.lit(False), F.lit(None).cast("string"))
        for key, option in rules:
            hit = hit.when(part.contains(key), F.lit(option))
        return hit

    found = F.array_compact(F.transform(F.split(F.lower(cell), ","), first_rule))
    return F.coalesce(F.array_sort(F.array_distinct(found)), empty_strings())


def options_anywhere(c: str | Column, rules: Rules = OPTION_RULES) -> Column:
    """Every rule contained anywhere in the cell. Sorted set."""
    cell = F.lower(_col(c).cast("string"))
    found = F.array_compact(F.array(*[
        F.when(cell.contains(key), F.lit(option)) for key, option in rules]))
    return F.array_sort(F.array_distinct(found))


def options_among(c: str | Column, targets: Sequence[str] = BASELINE_TARGETS) -> Column:
    """Targets contained in the cell (case matters), in target order."""
    cell = _col(c).cast("string")
    return F.array_compact(F.array(*[
        F.when(cell.contains(t), F.lit(t)) for t in targets]))


def multi_hot(selected: Column, options: Sequence[str] = OPTIONS) -> Column:
    return F.array(*[F.array_contains(selected, o).cast("int") for o in options])


def pair_flags(selected: Column, options: Sequence[str] = OPTIONS) -> Column:
    """1 where both options of a pair are selected; pairs (i, j), i < j, in order."""
    return F.array(*[
        (F.array_contains(selected, a) & F.array_contains(selected, b)).cast("int")
        for a, b in combinations(options, 2)])


def log_count(selected: Column) -> Column:
    return F.log1p(F.size(selected).cast("double"))
