"""Column expressions against the fitted stages."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from twinreach.operators import model_columns as mc
from twinreach.operators import models as md

ROWS = [(i, "abc"[i % 3] if i % 11 else None, float(i % 17) if i % 13 else None,
         float("nan") if i % 19 == 0 else i / 7, int((i % 3 == 1) != (i % 17 > 8)), "x") for i in range(400)]
SCHEMA = "user_id long, genre string, hours double, age double, label int, probability string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


def fitted(rows, est, **kw):
    return md.fit(rows.drop("probability"), est, ["genre"], ["hours", "age"], **kw)


def assert_same(model, df):
    want = {r["user_id"]: r for r in md.score(model, df.drop("probability"), ["hours", "age"], keep=["user_id"]).collect()}
    got = mc.score_columns(model, df, keep=["user_id"]).collect()
    assert len(got) == len(want) == df.count()
    for r in got:
        w = want[r["user_id"]]
        assert r["prediction"] == w["prediction"]
        if "probability" in w:
            assert math.isclose(r["probability"], w["probability"], rel_tol=1e-9, abs_tol=1e-12)
        else:
            assert "probability" not in r
    return {r["prediction"] for r in got}


@pytest.mark.parametrize("name", ["Logistic Regression", "Decision Tree", "Random Forest", "SVM",
                                  "Gradient Boosting"])
@pytest.mark.parametrize("scale", [False, True])
def test_every_kind_equals_its_stages(spark, rows, name, scale):
    model = fitted(rows, md.candidate_classifiers()[name], scale=scale)
    seen = assert_same(model, rows)
    assert name in ("Logistic Regression", "SVM") or seen == {0, 1}
    # values the fit never saw, nulls and NaN in every column, far-off numbers
    other = spark.createDataFrame([(1, "new", None, None, None, None), (2, None, float("nan"), -1e300, 1, "p"),
                                   (3, "", 1e300, 0.0, 0, ""), (4, "a", 3.0, 4.0, 1, "x")], SCHEMA)
    assert_same(model, other)
    assert mc.score_columns(model, other.limit(0)).count() == 0


def test_deep_trees_and_thresholds(rows):
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier

    assert_same(fitted(rows, DecisionTreeClassifier(labelCol="label", maxDepth=15)), rows)
    assert_same(fitted(rows, RandomForestClassifier(labelCol="label", numTrees=7, maxDepth=9, seed=3)), rows)
    for t in (0.0, 0.4, 0.45, 1.0):
        assert_same(fitted(rows, LogisticRegression(labelCol="label", threshold=t)), rows)


def test_saved_and_loaded(rows, tmp_path):
    model = fitted(rows, md.gbt())
    md.save_model(model, str(tmp_path / "m"))
    assert_same(md.load_model(str(tmp_path / "m")), rows)


def test_kept_columns_and_rounding(rows):
    model = fitted(rows, md.gbt())
    out = mc.score_columns(model, rows, digits=2, prefix="p_")
    assert out.columns == [*rows.columns, "p_prediction", "p_probability"]
    assert out.where(F.col("p_probability") != F.round("p_probability", 2)).count() == 0


def test_scan_reads_the_used_columns_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.withColumn("filler", F.lit("f")).write.parquet(path)
    model = fitted(rows, md.gbt())
    plan = mc.score_audience_columns(model, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "filler" not in schema and "label" not in schema
    assert "UDF" not in plan and "Exchange" not in plan


def test_what_is_not_compiled_is_refused(rows):
    model = fitted(rows, md.gbt())
    with pytest.raises(ValueError, match="max_nodes"):
        mc.score_columns(model, rows, max_nodes=10)
    clean = rows.select("label", F.col("user_id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    other = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v"),
                             PCA(k=1, inputCol="v", outputCol="features"), md.gbt()]).fit(clean)
    with pytest.raises(ValueError, match="PCA"):
        mc.score_columns(other, clean)


@pytest.mark.parametrize("name", ["Logistic Regression", "Random Forest", "SVM"])
def test_scored_in_a_session_that_has_observed_a_frame(spark, rows, name):
    seen = Observation()
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3
    assert seen.get == {"n": 3}
    est = md.candidate_classifiers()[name]
    assert_same(fitted(rows, est), rows)
    metrics, models = md.compare_classifiers(rows.drop("probability"), rows.drop("probability"), ["genre"],
                                             ["hours", "age"], candidates={name: est})
    assert [r["model"] for r in metrics.collect()] == [name]
    assert_same(models[name], rows)
