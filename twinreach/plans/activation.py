"""Activation: score the whole audience, keep the predicted positives and
publish them as a new version for downstream readers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from twinreach.operators.models import score_audience
from twinreach.plans.training import unlabelled_frame
from twinreach.sources.tables import newest_version, publish_snapshot, read_snapshot


def next_version(spark: SparkSession, root: str) -> int:
    """1 + the newest published version (1 when nothing is published)."""
    return (newest_version(spark, root) or 0) + 1


def activate(model: PipelineModel, features: DataFrame, num, root: str,
             version: int | None = None, key: str = "user_id",
             prepared: bool = False) -> DataFrame:
    """Publish the ids the model predicts positive; returns the published
    version as read back (that publication's folder only).

    ``features`` is the feature table, or with ``prepared`` a frame already
    in model-input form (e.g. ``TrainingResult.audience()``).
    """
    spark = features.sparkSession
    version = version or next_version(spark, root)
    frame = features if prepared else unlabelled_frame(features)
    positives = score_audience(model, frame, num, key)
    publish_snapshot(positives, root, version)
    return read_snapshot(spark, root, version)
