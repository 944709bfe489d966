"""Look-alike classifiers on Spark ML.

The reference trains single-machine models on a pandas copy; here fitting,
scoring and evaluation are Spark ML jobs over partitioned data.  Prepared
feature vectors that several candidates read are written once, as are the
frames they come from.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.functions.columns import positive_probability
from twinreach.operators.frames import align_to, dedupe_rows, drop_helper_columns, fill_numeric
from twinreach.operators.metrics import classification_metrics
from twinreach.operators.prep import cast_numeric, feature_stages
from twinreach.operators.sampling import undersample
from twinreach.session import cut_lineage, scratch_path


def candidate_classifiers(label: str = "label", features: str = "features", seed: int = 42) -> dict:
    """The five candidates; their names are fixed values.  The reference's kernel SVM has no Spark ML
    counterpart: ``LinearSVC`` (linear kernel, no probability) stands in."""
    return {
        "Logistic Regression": LogisticRegression(labelCol=label, featuresCol=features),
        "Decision Tree": DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed),
        "Random Forest": RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed),
        "SVM": LinearSVC(labelCol=label, featuresCol=features),
        "Gradient Boosting": GBTClassifier(labelCol=label, featuresCol=features, maxIter=10,
                                           seed=seed),
    }


def gbt(label: str = "label", features: str = "features", max_iter: int = 10, seed: int = 42):
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter, seed=seed)


def without_summary(model, spark):
    """The fitted ``model`` as read back from storage, without the summary of
    its training.  Scoring tasks carry the model, the summary refers to the
    session, and a session that has observed a frame cannot be serialised."""
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def fit(train: DataFrame, estimator, cat, num, impute: bool = True,
        scale: bool = False) -> PipelineModel:
    """Preparation stages + ``estimator`` fitted as one pipeline."""
    pipe = Pipeline(stages=feature_stages(cat, num, impute=impute, scale=scale) + [estimator])
    fitted = pipe.fit(cast_numeric(train, num))
    return PipelineModel(stages=[without_summary(m, train.sparkSession) for m in fitted.stages])


def score(model: PipelineModel, df: DataFrame, num, keep=None, digits: int | None = None) -> DataFrame:
    """Apply a fitted pipeline: ``prediction`` and, when the model has one,
    the positive-class ``probability`` as a double (no Python UDF)."""
    out = model.transform(cast_numeric(df, num))
    cols = list(keep) if keep is not None else [c for c in df.columns]
    prob = None
    if "probability" in out.columns:
        prob = positive_probability("probability")
        if digits is not None:
            prob = F.round(prob, digits)
    sel = [F.col(c) for c in cols] + [F.col("prediction").cast("int").alias("prediction")]
    if prob is not None:
        sel.append(prob.alias("probability"))
    return out.select(*sel)


def evaluate(model: PipelineModel, test: DataFrame, num, label: str = "label") -> DataFrame:
    scored = score(model, test, num, keep=[label])
    return classification_metrics(scored, label, "prediction")


def compare_classifiers(train: DataFrame, test: DataFrame, cat, num, candidates=None,
                        label: str = "label"):
    """Fit every candidate on ``train``, evaluate on ``test``.

    Returns ``(metrics, models)``: a DataFrame with one row per candidate
    (``model, accuracy, weighted_precision, weighted_recall, f1``) and the
    fitted models by name.
    """
    candidates = candidates or candidate_classifiers(label)
    # preparation is shared: fitted once on the train side, and the vectors of
    # either side are written once for all candidates
    typed = cast_numeric(train, num)
    prep = Pipeline(stages=feature_stages(cat, num, scale=True)).fit(typed)
    vectors = cut_lineage(prep.transform(typed).select("features", label))
    held = cut_lineage(prep.transform(cast_numeric(test, num)).select("features", label))
    models, rows = {}, None
    for name, est in candidates.items():
        fitted = without_summary(est.fit(vectors), train.sparkSession)
        models[name] = PipelineModel(stages=[*prep.stages, fitted])
        scored = fitted.transform(held).select(label, F.col("prediction").cast("int").alias("prediction"))
        r = classification_metrics(scored, label, "prediction").select(F.lit(name).alias("model"), "*")
        rows = r if rows is None else rows.unionByName(r)
    return rows, models


def best_of(metrics: DataFrame, by: str = "f1") -> DataFrame:
    """Top row by ``by`` (ties: model name)."""
    return metrics.orderBy(F.col(by).desc(), F.col("model")).limit(1)


def best_model(metrics: DataFrame, models: dict, by: str = "f1") -> tuple[str, PipelineModel]:
    """Name and fitted pipeline of the candidate with the best ``by``."""
    name = best_of(metrics, by).first()["model"]
    return name, models[name]


def pseudo_label(model: PipelineModel, unlabelled: DataFrame, num, label: str = "label") -> DataFrame:
    """Score rows without a label and take the prediction as their label."""
    scored = score(model, unlabelled, num, keep=unlabelled.columns)
    return scored.drop("probability").withColumnRenamed("prediction", label) \
                 .withColumn(label, F.col(label).cast("int"))


def semi_supervised_frame(model: PipelineModel, labelled: DataFrame, unlabelled: DataFrame,
                          num, key: str = "user_id", label: str = "label",
                          prefer_true_label: bool = True, mark: str | None = None) -> DataFrame:
    """Pseudo-labelled rows aligned to the labelled columns, stacked with the
    labelled rows, numeric nulls set to 0.

    ``unlabelled`` holds rows that were kept from the model's training (the
    test side without its labels, new users).  With ``prefer_true_label`` a
    key that has a true label keeps only it; otherwise both rows stay, as in
    the reference.  ``mark`` names a column that is 1 for pseudo-labelled rows.
    """
    pseudo = align_to(pseudo_label(model, unlabelled, num, label), labelled.columns)
    if prefer_true_label:
        pseudo = pseudo.join(labelled.select(key).distinct(), key, "left_anti")
    if mark:
        pseudo, labelled = pseudo.withColumn(mark, F.lit(1)), labelled.withColumn(mark, F.lit(0))
    return fill_numeric(pseudo.unionByName(labelled, allowMissingColumns=True), 0)


def semi_supervised_fit(model: PipelineModel, train: DataFrame, test: DataFrame,
                        cat, num, estimator=None, key: str = "user_id", label: str = "label",
                        seed: int = 1, balance: bool = True):
    """Pseudo-label the test side, retrain on it and the train side, and
    evaluate the new model on the test side's true labels.

    The stacked rows are de-duplicated; with ``balance`` (default, as the
    reference's final model) the classes are undersampled to the minority
    size (exact, distributed).  Returns ``(model_2, metrics, rows)``, the rows
    being those of the retraining, with ``is_pseudo``.
    """
    combined = dedupe_rows(semi_supervised_frame(model, train, test.drop(label), num, key, label,
                                                 mark="is_pseudo"))
    if balance:
        combined = undersample(combined, label, key, seed=seed)
    # the fit reads its input many times: write it once instead of
    # re-running scoring and undersampling on every pass
    combined = cut_lineage(combined, rebalance=True)
    model_2 = fit(combined.drop("is_pseudo"), estimator or gbt(label), cat, num)
    return model_2, evaluate(model_2, test, num, label), combined


def score_audience(model: PipelineModel, features: DataFrame, num, key: str = "user_id") -> DataFrame:
    """Ids predicted positive (the activation list)."""
    return score(model, features, num, keep=[key]).where(F.col("prediction") == 1).select(key)


def scored_table(model: PipelineModel, df: DataFrame, num) -> DataFrame:
    """``df`` with its prediction and the positive-class probability as a
    number, without the pipeline's helper and vector columns."""
    return score(model, df, num, keep=drop_helper_columns(df).columns)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
