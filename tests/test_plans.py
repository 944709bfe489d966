"""End-to-end plans: pipeline stages, snapshots, sinks."""

import os


import __spark_entry__ as entry
from twinreach.operators import frames as fr
from twinreach.session import scratch_path
from twinreach.sources import fixtures as fx
from twinreach.sources import tables as tb
from twinreach.plans.activation import next_version

from conftest import SF_SMALL


def test_pipeline_materialises_every_stage(spark):
    kpi = entry.queries()["pipeline_kpi"](spark, SF_SMALL)
    rows = kpi.collect()
    assert len(rows) == 1 and dict(kpi.dtypes) == {
        "churned_users": "int", "sub_revenue": "float", "ad_revenue": "float"}


def test_snapshot_read_is_of_the_newest_folder_only(spark):
    lab = fx.labelled(spark, SF_SMALL)
    root = scratch_path(spark, "snap")
    assert next_version(spark, root) == 1
    tb.publish_snapshot(lab, root, 1)
    tb.publish_snapshot(lab.where("label = 1"), root, 2)
    assert next_version(spark, root) == 3
    newest = tb.read_snapshot(spark, root)
    assert newest.count() == lab.where("label = 1").count()
    assert tb.read_snapshot(spark, root, 1).count() == lab.count()
    assert {"/versions/2-" in f for f in newest.inputFiles()} == {True}


def test_an_empty_publication_is_the_newest(spark):
    lab = fx.labelled(spark, SF_SMALL)
    root = scratch_path(spark, "snap")
    tb.publish_snapshot(lab, root, 1)
    tb.publish_snapshot(lab.where("label = 7"), root, 2)
    assert next_version(spark, root) == 3
    newest = tb.read_snapshot(spark, root)
    assert newest.count() == 0 and newest.columns == [*lab.columns, "version"]
    tb.publish_snapshot(lab.where("label = 7"), root, 1)  # replaces the rows of version 1
    assert tb.read_snapshot(spark, root, 1).count() == 0


def test_republishing_a_version_replaces_it(spark):
    lab = fx.labelled(spark, SF_SMALL)
    root = scratch_path(spark, "snap")
    tb.publish_snapshot(lab, root, 1)
    tb.publish_snapshot(lab.where("label = 1"), root, 2)
    tb.publish_snapshot(lab.where("label = 1"), root, 2)  # a re-run of the same publication
    assert tb.read_snapshot(spark, root, 2).count() == lab.where("label = 1").count()
    assert tb.read_snapshot(spark, root, 1).count() == lab.count()  # other versions kept


def test_json_sink_writes_no_marker_files(spark):
    path = scratch_path(spark, "json").replace("file:", "")
    tb.write_json(fx.seed(spark, SF_SMALL), path, files=3)
    names = os.listdir(path)
    assert not [n for n in names if n.startswith(("_SUCCESS", "_committed", "_started"))]
    assert len([n for n in names if n.endswith(".json")]) == 3


def test_materialize_with_declared_schema(spark):
    a = fx.audience(spark, SF_SMALL)
    from twinreach.operators.conform import AUDIENCE_SILVER_SCHEMA, as_strings, conform

    silver = conform(as_strings(a), AUDIENCE_SILVER_SCHEMA, missing="null")
    assert silver.columns == [f.name for f in AUDIENCE_SILVER_SCHEMA.fields]
    out = tb.materialize(silver, scratch_path(spark, "silver"), schema=AUDIENCE_SILVER_SCHEMA)
    assert out.count() == a.count()
    assert dict(out.dtypes)["num_children"] == "int"


def test_activation_publishes_new_versions(spark):
    out = entry.queries()["activation"](spark, SF_SMALL)
    assert {r.version for r in out.select("version").distinct().collect()} == {2}


def test_map_column_keeps_unknown_and_unchosen(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "zzz", "y")], "user_id string, src string, dst string")
    all_rows = {r.user_id: r.dst for r in fr.map_column(df, "src", "dst", {"a": "A"}, share=1.0).collect()}
    assert all_rows == {"1": "A", "2": "y"}
    none = {r.user_id: r.dst for r in fr.map_column(df, "src", "dst", {"a": "A"}, share=0.0).collect()}
    assert none == {"1": "x", "2": "y"}


def test_strict_conform_raises_on_bad_text(spark):
    import pytest
    from twinreach.operators.conform import conform, ddl_schema

    df = spark.createDataFrame([("x1",)], "n string")
    schema = ddl_schema("n int")
    assert conform(df, schema).collect()[0].n is None
    with pytest.raises(Exception):
        conform(df, schema, strict=True).collect()


def test_key_report_counts_null_and_repeated_keys(spark):
    from twinreach.operators.conform import key_report

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    r = key_report(df, "k").collect()[0]
    assert (r.n_rows, r.null_keys, r.distinct_keys, r.duplicated_keys, r.duplicate_rows) == (5, 2, 2, 1, 2)


def test_a_later_landing_brings_declared_columns_and_fractions(spark):
    from twinreach.operators.conform import AUDIENCE_SILVER_SCHEMA, FEATURES_SCHEMA
    from twinreach.plans.feature_pipeline import run_feature_pipeline

    land = {n: scratch_path(spark, f"land-{n}") for n in ("audience", "seed", "impressions")}
    root = scratch_path(spark, "later")

    def landing(audience, columns, prices):
        tb.write_json(spark.createDataFrame(audience, columns), land["audience"])
        tb.write_json(spark.createDataFrame([("a",)], "user_id_seed string"), land["seed"])
        tb.write_json(spark.createDataFrame([(str(p), p) for p in prices],
                                            ["ImpressionID", "WinningPrice"]), land["impressions"])
        return run_feature_pipeline(spark, land, root, as_of=fx.AS_OF)

    first = landing([("a", 1.0), ("b", 2.0)], "user_id string, subscription_length double", [1, 2])
    assert first.silver.columns == AUDIENCE_SILVER_SCHEMA.names
    assert first.features.dtypes == [(f.name, f.dataType.simpleString()) for f in FEATURES_SCHEMA.fields]
    assert first.kpi.collect()[0].ad_revenue == 3.0
    then = landing([("c", 3.0, 0.5, "Basic", 4)],
                   "user_id string, subscription_length double, ad_interaction_rate double, "
                   "subscription_type string, num_children int", [0.25, 0.5])
    got = {r.user_id: r for r in then.features.collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert (got["c"].ad_interaction_rate, got["c"].num_children) == (0.5, 4)
    assert (got["c"].ad_interaction_percentile, got["a"].ad_interaction_percentile) == (1.0, 0.0)
    assert got["c"].monthly_subscription_revenue == 6.99 and got["a"].subscription_length == 1.0
    assert then.kpi.collect()[0].ad_revenue == 3.75
