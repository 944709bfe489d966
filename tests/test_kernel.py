"""Random Fourier features and the SVM on them."""

import numpy as np
from pyspark.sql import functions as F

from twinreach.operators import kernel as kn


def test_products_are_near_the_kernel_and_do_not_depend_on_partitions(spark):
    points = np.random.default_rng(1).normal(size=(12, 3))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, a double, b double, c double")
    w = kn.directions(3, 4000, 0.3, 7)
    col = kn.fourier_features([F.col(c) for c in "abc"], w)
    z = [np.array([r["z"] for r in df.repartition(n).select("id", col.alias("z")).orderBy("id").collect()])
         for n in (1, 5)]
    assert np.array_equal(*z)
    want = np.exp(-0.3 * ((points[:, None] - points[None]) ** 2).sum(-1))
    assert np.abs(z[0] @ z[0].T - want).max() < 0.12  # 2 exp(-n e^2 / 8) a pair, 66 pairs: under 10 %


def test_ring_with_nulls_constant_columns_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, p), 5.0, None, int((p ** 2).sum() < 0.6)) for i, p in enumerate(rng.uniform(-1, 1, (1500, 2)))]
    rows += [(2000, None, float("nan"), 5.0, None, 1), (2001, 0.9, 0.9, None, None, None)]
    df = spark.createDataFrame(rows, "id int, x double, y double, features double, prediction double, label int")
    svm = kn.fit_kernel_svm(df, ["x", "y", "features", "prediction"], gamma=1.0, n=100)
    out = svm.score(df, keep=["id", "x", "y", "features", "label"])
    assert out.columns == ["id", "x", "y", "features", "label", "prediction"]
    got = out.collect()
    assert len(got) == len(rows)
    assert sum(r["label"] == r["prediction"] for r in got) / len(rows) > 0.93
    assert {r["id"]: r["prediction"] for r in got}[2000] == 1  # the means stand in: the centre
    assert svm.score(df.limit(0), keep=["id"]).count() == 0


def test_fit_keeps_no_projection_and_reaches_the_loss_of_spark_ml(spark, monkeypatch):
    from pyspark.ml.classification import LinearSVC

    rng = np.random.default_rng(5)
    rows = [(*map(float, p), int((p ** 2).sum() < 0.6)) for p in rng.uniform(-1, 1, (800, 2))]
    df = spark.createDataFrame(rows, "x double, y double, label int").repartition(3)
    kept = []
    write = kn.cut_lineage
    monkeypatch.setattr(kn, "cut_lineage", lambda d, **kw: kept.append(d.columns) or write(d, **kw))
    svm = kn.fit_kernel_svm(df, ["x", "y"], n=60, reg=1e-2)
    assert [len(c) for c in kept] == [4]  # columns, label and times, not n numbers a row
    z = np.array([r["v"].toArray() for r in df.select(svm.vector().alias("v")).collect()])
    y = np.array([2 * r["label"] - 1 for r in df.select("label").collect()])

    def loss(coefficients, intercept):
        return np.maximum(0, 1 - y * (z @ coefficients + intercept)).mean() + 5e-3 * (
            (coefficients * z.std(0)) ** 2).sum()

    whole = LinearSVC(regParam=1e-2).fit(df.select(svm.vector().alias("features"), "label"))
    assert loss(svm.coefficients, svm.intercept) <= 1.01 * loss(whole.coefficients.toArray(), whole.intercept)
