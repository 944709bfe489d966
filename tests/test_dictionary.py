"""Category dictionaries against the string indexer."""

import pytest
from pyspark.sql import functions as F

from twinreach.operators import prep as pp

VALUES = ["hot"] * 300 + [f"v{i % 40}" for i in range(100)] + ["é", "", " ", "A", "a"] + [None] * 150


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(VALUES)), "id long, v string").repartition(5)


@pytest.mark.parametrize("buckets,head", [(None, 1000), (7, 3), (3, 0)])
def test_equals_the_string_indexer(rows, buckets, head):
    want = {r["id"]: r["v_index"] for r in pp.string_index(rows, ["v"]).collect()}
    # columns that stand in the way of the output's name
    df = rows.withColumn("at", F.lit("old"))
    got = pp.index_by_dictionary(df, "v", pp.category_dictionary(df, "v", buckets=buckets), "at", head)
    assert got.columns == ["id", "v", "at"]
    got = got.collect()
    assert len(got) == len(VALUES) and {r["id"]: r["at"] for r in got} == want


def test_rare_null_and_unseen_values_share_the_last_index(spark, rows):
    words = pp.category_dictionary(rows, "v", min_count=3)
    kept = [r["_cd_value"] for r in words.orderBy("_cd_index").collect()]
    assert kept == ["hot"] + sorted(f"v{i}" for i in range(20))
    other = spark.createDataFrame([("new",), ("hot",), ("v39",), (None,), ("v1",)], "v string")
    got = {r["v"]: r["i"] for r in pp.index_by_dictionary(other, "v", words, "i", head=1).collect()}
    assert got == {"new": 21, "hot": 0, "v39": 21, None: 21, "v1": kept.index("v1")}


def test_empty_tables_and_null_only(spark, rows):
    empty = pp.category_dictionary(rows.limit(0), "v")
    assert empty.count() == 0
    assert {r["i"] for r in pp.index_by_dictionary(rows, "v", empty, "i").collect()} == {0}
    assert pp.index_by_dictionary(rows.limit(0), "v", pp.category_dictionary(rows, "v"), "i").count() == 0
    nulls = spark.createDataFrame([(None,)], "v int")
    assert pp.index_by_dictionary(nulls, "v", pp.category_dictionary(nulls, "v"), "i").collect()[0]["i"] == 0


def test_a_hot_value_is_not_shuffled(rows):
    words = pp.category_dictionary(rows, "v")
    plan = pp.index_by_dictionary(rows, "v", words, "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" in plan and "strategy=broadcast" in plan.lower().replace(" ", "")
