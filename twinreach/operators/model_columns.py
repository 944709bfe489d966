"""Fitted pipelines as column expressions.

``models.score`` runs each stage of a pipeline as its own transformer: index,
one-hot vector, assembled vector, model, and two functions to take numbers out
of vectors again.  Here the fitted numbers (labels, means, thresholds, leaves,
coefficients) become one expression per used input, and one for the result.  A
tree is nested ``CASE WHEN``.  Scoring is then two projections over the columns
that the model really uses: no vectors, the scan is pruned to those columns,
and everything runs in generated code.

Compiled are the stages of ``prep.feature_stages`` (string index and one-hot
with ``handleInvalid='keep'``, mean imputation, assembly, scaling) and binary
logistic regression, linear SVC, decision tree, random forest and boosting.
Another stage, another option of a stage, or more than ``max_nodes`` tree nodes
raise ``ValueError``: use ``models.score`` there.  Where the generated method
of a large ensemble is beyond what the JVM compiles, set
``spark.sql.codegen.hugeMethodLimit`` to 8000: Spark then splits it.

Null and unseen categories, and null and NaN numbers, give what the stages
give.  An empty frame gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import (
    ImputerModel,
    OneHotEncoderModel,
    StandardScalerModel,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_NODES = 20_000
NAN = float("nan")


def _refuse(what):
    raise ValueError(f"not compiled to columns: {what}")


def _missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


# -- preparation -------------------------------------------------------------

def _columns_of(stage, names):
    multi = stage.isSet(names + "s")
    return list(stage.getOrDefault(names + "s")) if multi else [stage.getOrDefault(names)]


def _index(stage, known):
    if stage.getHandleInvalid() != "keep":
        _refuse("string index without handleInvalid='keep'")
    for c, out, labels in zip(_columns_of(stage, "inputCol"), _columns_of(stage, "outputCol"),
                              stage.labelsArray):
        known[out] = (F.col(c).cast("string"), list(labels))


def _one_hot(stage, known):
    if stage.getHandleInvalid() != "keep" or not stage.getDropLast():
        _refuse("one-hot without handleInvalid='keep' and dropLast")
    for c, out, size in zip(_columns_of(stage, "inputCol"), _columns_of(stage, "outputCol"),
                            stage.categorySizes):
        text, labels = known[c]
        flags = [text.eqNullSafe(F.lit(v)) for v in labels]
        # the indexer's own place for null and unseen values
        flags.append(~F.coalesce(text.isin(labels), F.lit(False)) if labels else F.lit(True))
        known[out] = [F.when(f, 1.0).otherwise(0.0) for f in flags[:size]]


def _impute(stage, known):
    means = stage.surrogateDF.first().asDict()  # one row
    missing = stage.getMissingValue()
    for c, out in zip(_columns_of(stage, "inputCol"), _columns_of(stage, "outputCol")):
        x = F.col(c).cast("double")
        gone = F.isnan(x) if math.isnan(missing) else x == F.lit(missing)
        known[out] = [F.when(x.isNull() | gone, F.lit(float(means[c]))).otherwise(x)]


def _assemble(stage, known):
    how, slots = stage.getHandleInvalid(), []
    if how == "skip":
        _refuse("assembly that skips rows")
    for c in stage.getInputCols():
        if isinstance(known.get(c), list):
            slots += known[c]
            continue
        x = F.col(c).cast("double")
        slots.append(F.coalesce(x, F.lit(NAN)) if how == "keep" else F.when(
            _missing(x), F.raise_error(F.lit(f"{c} is null or NaN")).cast("double")).otherwise(x))
    known[stage.getOutputCol()] = slots


def _scale(stage, known):
    slots = known[stage.getInputCol()]
    if stage.getWithMean():
        slots = [x - F.lit(float(m)) for x, m in zip(slots, stage.mean)]
    if stage.getWithStd():
        slots = [x * F.lit(1 / float(s) if s else 0.0) for x, s in zip(slots, stage.std)]
    known[stage.getOutputCol()] = slots


PREPARE = {StringIndexerModel: _index, OneHotEncoderModel: _one_hot, ImputerModel: _impute,
           VectorAssembler: _assemble, StandardScalerModel: _scale}


# -- models: (expression of the slots, used slots) -----------------------------

class _Slots:
    """Slots as columns of a projection; only those asked for are computed."""

    def __init__(self, slots):
        self.slots, self.used = slots, set()

    def __getitem__(self, i):
        self.used.add(i)
        return F.col(f"_mc_{i}")

    def project(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[self.slots[i].alias(f"_mc_{i}") for i in sorted(self.used)])


def _goes_left(split, slots) -> Column:
    x = slots[split.featureIndex()]
    if split.getClass().getSimpleName() == "ContinuousSplit":
        return x <= F.lit(float(split.threshold()))
    return x.isin([float(v) for v in split.leftCategories()])


def _tree(node, slots, leaf):
    """Nested conditions over a tree of the model; ``leaf`` turns a leaf into
    its value."""
    if node.subtreeDepth() == 0:
        return F.lit(leaf(node))
    return F.when(_goes_left(node.split(), slots), _tree(node.leftChild(), slots, leaf)).otherwise(
        _tree(node.rightChild(), slots, leaf))


def _share(node) -> float:
    """Share of class 1 among the training weight of a leaf."""
    none, one = node.impurityStats().stats()
    return one / (none + one) if none + one else 0.0


def _trees(model, slots, max_nodes):
    if model.totalNumNodes > max_nodes:
        _refuse(f"{model.totalNumNodes} tree nodes, max_nodes is {max_nodes}")
    if model.numClasses != 2 or model.isSet("thresholds"):
        _refuse("more than two classes, or thresholds")
    if isinstance(model, GBTClassificationModel):
        margin = reduce(add, [F.lit(float(w)) * _tree(t._java_obj.rootNode(), slots, lambda n: n.prediction())
                              for w, t in zip(model.treeWeights, model.trees)])
        return margin, lambda m: (m > 0, 1.0 - 1.0 / (1.0 + F.exp(2.0 * m)))
    shares = [_tree(t._java_obj.rootNode(), slots, _share) for t in model.trees]
    # a tie goes to class 0, as in the model
    return reduce(add, shares) / F.lit(float(len(shares))), lambda p: (p > 0.5, p)


def _single_tree(model, slots, max_nodes):
    if model.numNodes > max_nodes:
        _refuse(f"{model.numNodes} tree nodes, max_nodes is {max_nodes}")
    if model.numClasses != 2 or model.isSet("thresholds"):
        _refuse("more than two classes, or thresholds")
    return _tree(model._java_obj.rootNode(), slots, _share), lambda p: (p > 0.5, p)


def _linear(model, slots, _max_nodes):
    if model.numClasses != 2:
        _refuse("more than two classes")
    margin = reduce(add, [F.lit(float(w)) * slots[i] for i, w in enumerate(model.coefficients) if w],
                    F.lit(0.0)) + F.lit(float(model.intercept))
    if isinstance(model, LinearSVCModel):
        return margin, lambda m: ((m > model.getThreshold()) & ~F.isnan(m), None)
    t = model.getThreshold()
    cut = -math.inf if t <= 0 else math.inf if t >= 1 else math.log(t / (1 - t))
    return margin, lambda m: ((m > cut) & ~F.isnan(m), 1.0 / (1.0 + F.exp(-m)))


MODELS = {LogisticRegressionModel: _linear, LinearSVCModel: _linear,
          DecisionTreeClassificationModel: _single_tree,
          RandomForestClassificationModel: _trees, GBTClassificationModel: _trees}


def score_columns(model: PipelineModel, df: DataFrame, keep=None, digits: int | None = None,
                  max_nodes: int = MAX_NODES, prefix: str = "") -> DataFrame:
    """``keep`` columns (default: all) with ``<prefix>prediction`` and, where the
    model has one, the positive-class ``<prefix>probability``: the rows of
    ``models.score`` without its vectors."""
    known: dict = {}
    *before, last = model.stages
    for stage in before:
        PREPARE.get(type(stage), lambda s, _k: _refuse(type(s).__name__))(stage, known)
    if type(last) not in MODELS:
        _refuse(type(last).__name__)
    slots = _Slots(known[last.getFeaturesCol()])
    raw, finish = MODELS[type(last)](last, slots, max_nodes)
    rows = slots.project(df).withColumn("_mc_raw", raw)
    positive, probability = finish(F.col("_mc_raw"))
    out = [F.col(c) for c in (keep if keep is not None else df.columns)]
    out.append(positive.cast("int").alias(prefix + "prediction"))
    if probability is not None:
        probability = F.round(probability, digits) if digits is not None else probability
        out.append(probability.alias(prefix + "probability"))
    return rows.select(*out)


def score_audience_columns(model: PipelineModel, features: DataFrame, key: str = "user_id") -> DataFrame:
    """``models.score_audience`` through expressions: ids predicted positive."""
    return score_columns(model, features, keep=[key]).where(F.col("prediction") == 1).select(key)
