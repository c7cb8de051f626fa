"""Preparation of a whole survey: split, fit on the training part, transform."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from ..functions.fixed import MULTI_POSITIONS, POSITION_CUTS, RATING_POSITIONS, TEXT_POSITIONS
from ..operators import records, splits
from .pipeline import FeatureConfig, FeatureModel, FeaturePipeline, pooled_layout, prepared


def config_by_position(columns: Sequence[str], row_id: str,
                       make: Callable[..., FeatureConfig] = pooled_layout, **more) -> FeatureConfig:
    """Layout of a survey file whose questions are known by their place.

    ``columns`` are the columns of the file, without an added row key."""
    def at(positions):
        return [columns[i] for i in positions]
    return make(row_id, at(TEXT_POSITIONS), at(RATING_POSITIONS), at(MULTI_POSITIONS), **more)


def prepare_training(rows: DataFrame, config: FeatureConfig, label: str,
                     split: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, FeatureModel]:
    """Features of all parts (``row_id, split, label, idx, value``), fitted on the training part.

    ``split`` adds the column ``split``, for example ``splits.split_by_group``."""
    parts = prepared(records.label_as_text(split(records.require_column(rows, label)), label), config, ["split", label])
    model = FeaturePipeline(config).fit(parts.filter("split = 'train'"))
    return model.transform(parts, keep=["split", label]), model


def prepare_shuffled_test(rows: DataFrame, config: FeatureConfig, cuts: Sequence[int] = POSITION_CUTS,
                          seed: int = 42) -> tuple[DataFrame, FeatureModel]:
    """Shuffle, cut, fit on the first part and return the features of the last part."""
    parts = prepared(splits.split_shuffled(rows, config.row_id, cuts, seed=seed), config, ["split"])
    model = FeaturePipeline(config).fit(parts.filter("split = 'train'"))
    return model.transform(parts.filter("split = 'test'")), model


def prepare_file(rows: DataFrame, config: FeatureConfig) -> tuple[DataFrame, FeatureModel]:
    """Fit on all rows and transform them; ratings take the modes of these rows."""
    rows = prepared(rows, config)
    model = FeaturePipeline(replace(config, modes_from="self")).fit(rows)
    return model.transform(rows), model
