"""Row and column clean-up of response tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import GROUP_COLUMN, LABEL_COLUMN


def quoted(name: str) -> str:
    """Column reference that is safe for question texts (dots, commas, backticks)."""
    return "`" + name.replace("`", "``") + "`"


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.select(*[F.col(quoted(df.columns[i])) for i in positions])


def require_column(df: DataFrame, name: str = LABEL_COLUMN) -> DataFrame:
    """Fail while the plan is built, not when it runs."""
    if name not in df.columns:
        raise ValueError(f"missing column {name!r}; found {df.columns}")
    return df


def feature_columns(df: DataFrame, label: str = LABEL_COLUMN) -> list[str]:
    return [c for c in df.columns if c != label]


def fill_empty(df: DataFrame) -> DataFrame:
    """Every column as text, missing cells as the empty string."""
    return df.select(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(c)
                       for c in df.columns])


def one_document(df: DataFrame, label: str = LABEL_COLUMN, group: str = GROUP_COLUMN,
                 keep: Sequence[str] = (), out: str = "text") -> DataFrame:
    """Join all answers of a row to one text, in column order.

    The group column is not an answer; ``keep`` columns (a row key) are passed on.
    """
    df = require_column(df.drop(group), label)
    answers = [c for c in feature_columns(df, label) if c not in keep]
    filled = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in answers]
    return df.select(*keep, F.concat_ws(" ", *filled).alias(out),
                     F.coalesce(F.col(quoted(label)).cast("string"), F.lit("")).alias(label))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep rows without any missing cell. (``dropna`` itself does not accept names with dots.)"""
    complete = F.lit(True)
    for f in df.schema.fields:
        cell = F.col(quoted(f.name))
        complete = complete & cell.isNotNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            complete = complete & ~F.isnan(cell)
    return df.filter(complete)


def drop_unlabelled(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Keep rows whose label is neither missing nor blank."""
    value = F.col(quoted(label)).cast("string")
    return df.filter(value.isNotNull() & (F.trim(F.regexp_replace(value, r"\s", " ")) != ""))


def keep_labels(df: DataFrame, labels: Sequence, label: str = LABEL_COLUMN) -> DataFrame:
    return df.filter(F.col(quoted(label)).isin(*labels))


def label_as_text(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Label as a string; a missing label stays missing."""
    return df.withColumn(label, F.col(quoted(label)).cast("string"))


def label_classes(df: DataFrame, label: str = LABEL_COLUMN) -> list[str]:
    """Distinct labels in order; one driver row per class."""
    rows = df.select(F.col(quoted(label)).cast("string").alias("c")).distinct().collect()
    return sorted(r["c"] for r in rows if r["c"] is not None)


def encode_label(df: DataFrame, classes: Sequence[str], label: str = LABEL_COLUMN,
                 out: str = "label_idx") -> DataFrame:
    """Position of the label among the sorted classes."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]),
                                F.col(quoted(label)).cast("string"))
    return df.withColumn(out, F.nullif(position, F.lit(0)).cast("int") - 1)
