"""Feature table, KPI row, labels, seed: edge rows and types."""

import datetime as dt

from pyspark.sql import functions as F

from twinreach.functions.columns import PRICES_CORRECTED, subscription_revenue
from twinreach.operators import features as feat
from twinreach.operators import kpi as kp
from twinreach.operators.seed import label_audience, select_seed
from twinreach.sources import fixtures as fx

from conftest import SF_SMALL


def test_revenue_presets(spark):
    df = spark.createDataFrame([("Premium",), ("Standard",), ("Basic",), ("Free Trial",), (None,)], "t string")
    pub = [r.r for r in df.select(subscription_revenue("t").alias("r")).collect()]
    cor = [r.r for r in df.select(subscription_revenue("t", PRICES_CORRECTED).alias("r")).collect()]
    assert pub == [20.0, 0.0, 6.99, 0.0, 0.0]
    assert cor == [20.0, 12.99, 6.99, 0.0, 0.0]


def test_feature_types_and_nulls(spark):
    a = fx.audience(spark, SF_SMALL)
    f = feat.lal_features(a, as_of=dt.date(2001, 8, 2))
    types = dict(f.dtypes)
    assert types["days_since_last_session"] == "int" and types["is_churn"] == "int"
    assert types["monthly_subscription_revenue"] == "double"
    assert f.count() == a.count()
    nulls = f.where(F.col("last_login_date").isNull()).select("is_churn").distinct().collect()
    assert [r.is_churn for r in nulls] in ([], [0])


def test_kpi_empty_impressions_is_null(spark):
    a = fx.audience(spark, SF_SMALL)
    f = feat.lal_features(a, as_of=fx.AS_OF)
    imp = fx.impressions(spark, SF_SMALL).where(F.lit(False))
    row = kp.kpi(f, imp).collect()[0]
    assert row.ad_revenue is None and row.churned_users >= 0 and row.sub_revenue > 0


def test_label_dedupe_and_fanout(spark):
    a = fx.audience(spark, SF_SMALL)
    s = fx.seed(spark, SF_SMALL)
    twice = s.unionByName(s)
    n_seed = s.count()
    assert label_audience(a, twice).count() == a.count()
    assert label_audience(a, twice, dedupe=False).count() == a.count() + n_seed
    assert label_audience(a, s).where("label = 1").count() == n_seed


def test_seed_filters_reach_the_scan(spark):
    s = select_seed(spark.read.parquet(f"{SF_SMALL}/customer.parquet")
                    .withColumnRenamed("c_mktsegment", "favorite_genre")
                    .withColumn("user_id", F.col("c_custkey").cast("string")),
                    genres=("BUILDING",))
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), In(c_mktsegment" in plan or \
           "EqualTo(c_mktsegment" in plan
