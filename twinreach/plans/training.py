"""Look-alike training plan: label -> split -> compare -> pseudo-label ->
retrain -> evaluate, all on Spark.

The labelled training frame is checkpointed into the shared checkpoint
folder before the iterative fits, so a lost executor re-reads it instead of
recomputing the feature plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.functions.columns import epoch_seconds
from twinreach.operators import models as md
from twinreach.operators.frames import DEFAULT_EXCLUDE, split_columns
from twinreach.operators.sampling import hash_split
from twinreach.operators.seed import label_audience
from twinreach.session import cut_lineage  # noqa: F401  (re-exported)


def training_frame(features: DataFrame, seed: DataFrame, key: str = "user_id") -> DataFrame:
    """Feature table labelled against the seed, login date as epoch seconds."""
    return (label_audience(features, seed, key=key)
            .withColumn("last_login_date", epoch_seconds("last_login_date")))


def unlabelled_frame(features: DataFrame) -> DataFrame:
    return features.withColumn("last_login_date", epoch_seconds("last_login_date"))


@dataclass
class TrainingResult:
    train: DataFrame
    test: DataFrame
    categorical: list
    numeric: list
    model: PipelineModel
    # the whole labelled frame the split came from (a written table when
    # checkpointed): every audience row once, in model-input form
    data: DataFrame
    label: str = "label"

    def audience(self) -> DataFrame:
        """The whole audience in model-input form, without the label.

        Equal to ``unlabelled_frame(features)`` row for row (the labelling is
        a left join to distinct seed ids), but read from the table written
        before the fit, so the feature plan (percent ranks, joins) is not
        computed a second time for scoring.
        """
        return self.data.drop(self.label)


def fit_gbt(labelled: DataFrame, key: str = "user_id", share: float = 0.7, seed: int = 42,
            checkpoint: bool = True, exclude=DEFAULT_EXCLUDE) -> TrainingResult:
    """``exclude``: columns that are not features, such as ids or the columns
    of the seed rule.  Hash split, then preparation + GBT (10 rounds) fitted on the train side."""
    data = cut_lineage(labelled, rebalance=True) if checkpoint else labelled
    cat, num = split_columns(data.schema, exclude)
    train, test = hash_split(data, key, share, seed)
    model = md.fit(train, md.gbt(), cat, num)
    return TrainingResult(train, test, cat, num, model, data)


def compare(labelled: DataFrame, key: str = "user_id", share: float = 0.7, seed: int = 42,
            candidates=None, exclude=DEFAULT_EXCLUDE):
    """Five candidates on one split: ``(metrics frame, models, cat, num, test)``."""
    data = cut_lineage(labelled, rebalance=True)
    cat, num = split_columns(data.schema, exclude)
    train, test = hash_split(data, key, share, seed)
    metrics, models = md.compare_classifiers(train, test, cat, num, candidates)
    return metrics, models, cat, num, test
