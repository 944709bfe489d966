"""Classification metrics as DataFrames.

Everything starts from one ``groupBy(label, prediction).count()`` (partial
aggregation; the result has classes^2 rows), so the metrics of any number of
scored rows cost one pass and never leave the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes=(0, 1)) -> DataFrame:
    """Rows: true label; columns ``pred_<c>``: rows predicted as class c."""
    pred = F.col(prediction).cast("int")
    return (df.groupBy(F.col(label).cast("int").alias("label"))
              .agg(*[F.count_if(pred == c).alias(f"pred_{c}") for c in classes]))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           digits: int | None = 10) -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1 (one row).

    Same definitions as ``MulticlassClassificationEvaluator``: per class c of
    the label column, precision = hits / predicted c (0 when none), recall =
    hits / actual c, F1 their harmonic mean (0 when both are 0); weights are
    the class shares of the label column.
    """
    pairs = df.groupBy(F.col(label).cast("double").alias("_l"),
                       F.col(prediction).cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    actual = pairs.groupBy("_l").agg(F.sum("_n").alias("_act"),
                                     F.sum(F.when(F.col("_l") == F.col("_p"), F.col("_n"))
                                           .otherwise(0)).alias("_tp"))
    predicted = pairs.groupBy(F.col("_p").alias("_l")).agg(F.sum("_n").alias("_pred"))
    per_class = actual.join(predicted, "_l", "left")
    prec = F.when(F.coalesce(F.col("_pred"), F.lit(0)) == 0, F.lit(0.0)) \
            .otherwise(F.col("_tp") / F.col("_pred"))
    rec = F.col("_tp") / F.col("_act")
    per_class = per_class.select("_act", "_tp", prec.alias("_prec"), rec.alias("_rec"))
    f1 = F.when(F.col("_prec") + F.col("_rec") == 0, F.lit(0.0)).otherwise(
        2 * F.col("_prec") * F.col("_rec") / (F.col("_prec") + F.col("_rec")))
    n = F.sum("_act")
    out = per_class.agg(
        (F.sum("_tp") / n).alias("accuracy"),
        (F.sum(F.col("_prec") * F.col("_act")) / n).alias("weighted_precision"),
        (F.sum(F.col("_rec") * F.col("_act")) / n).alias("weighted_recall"),
        (F.sum(f1 * F.col("_act")) / n).alias("f1"))
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out
