"""Batch prediction: train once, save plain tables, score files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feats, forest as forests, models, records, terms as tt
from ..operators.distribute import materialize
from ..sources import artifacts, survey
from .pipeline import FeatureConfig, FeatureModel, FeaturePipeline, prepared


def train_forest(rows: DataFrame, config: FeatureConfig, label: str, model_dir: str, *, trees: int = 150,
                 depth: int = 10, min_leaf: int = 2, seed: int = 42
                 ) -> tuple[FeatureModel, RandomForestClassificationModel, list[str]]:
    """Fit layout and forest on ``rows`` and save both under ``model_dir``."""
    spark = rows.sparkSession
    labelled = records.drop_unlabelled(rows, label)
    rows = prepared(labelled, config)
    classes = records.label_classes(labelled, label)
    layout = FeaturePipeline(config).fit(rows)
    # Labels come from the given rows: the forest draws its samples by their order.
    coded = records.encode_label(labelled, classes, label).select(
        F.col(config.row_id).alias("row_id"), F.col("label_idx").cast("double").alias("label_idx"))
    data = feats.sparse_vectors(layout.transform(rows), layout.width, coded)
    model = models.forest(trees, depth, min_leaf, seed).fit(data)
    layout.save(f"{model_dir}/layout")
    model.write().overwrite().save(f"{model_dir}/forest_ml")
    artifacts.save_table(forests.nodes_of_model(spark, f"{model_dir}/forest_ml"), f"{model_dir}/nodes")
    artifacts.save_settings(spark, {"classes": classes}, f"{model_dir}/classes")
    return layout, model, classes


def predict_rows(rows: DataFrame, layout: FeatureModel, nodes: DataFrame, classes: Sequence[str]) -> DataFrame:
    """``row_id, prediction`` of every row; the features stay sparse. The rows are read and tokenised once."""
    rows = rows if tt.CELLS in rows.columns else prepared(rows, layout.config)
    ids = rows.select(F.col(layout.config.row_id).alias("row_id"))
    return forests.score_sparse(ids, layout.transform(rows), nodes, classes).select("row_id", "prediction")


def predict_all(spark: SparkSession, path: str, model_dir: str, multiline: bool = False) -> DataFrame:
    """Predictions for a survey file with the tables saved by ``train_forest``.

    A file without the key column of the layout gets generated row ids.
    """
    layout = FeatureModel.load(spark, f"{model_dir}/layout")
    nodes = artifacts.load_table(spark, f"{model_dir}/nodes")
    classes = artifacts.load_settings(spark, f"{model_dir}/classes")["classes"]
    rows = survey.read_survey(spark, path, multiline=multiline)
    if layout.config.row_id not in rows.columns:
        # Written once: generated ids must not change between the branches of the plan.
        rows = materialize(survey.with_row_id(rows, layout.config.row_id))
    return predict_rows(rows, layout, nodes, classes)
