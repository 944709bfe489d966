"""Enforced keys, large limits, repeatable samples, repeated JSON keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from twinreach.operators import frames as fr
from twinreach.operators import sampling as sm
from twinreach.plans.catalog import QUERIES
from twinreach.plans.compare import compare
from twinreach.plans.oracle import ORACLE
from twinreach.sources import tables as tb
from twinreach.streaming import ingest as ing

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["sample_wr", "sample_wr_lines", "limit_large", "limit_large_ties",
                                  "ingest_repeated_keys", "constrained_write", "kpi", "kpi_subcent",
                                  "churn_count", "features", "pct_distributed", "pct_date"])
def test_query_matches_its_sql(spark, duck_small, name):
    assert compare(QUERIES[name](spark, SF), duck_small, ORACLE[name]) == []


def test_refused_write_leaves_the_table(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    make = lambda rows: spark.createDataFrame(rows, "k int, part string, v int")
    keys = {"key": ["k", "part"], "not_null": ["v"]}
    assert tb.materialize_checked(make([(1, "a", 5), (1, "b", 6)]), root, **keys).accepted
    bad = [(1, "a", 5), (1, "a", 7), (2, "a", None), (None, "a", 1), (None, "a", 2), (3, "c", 3)]
    refused = tb.materialize_checked(make(bad), root, **keys)
    assert not refused.accepted
    assert {tuple(r) for r in refused.offences.collect()} == {
        (1, "a", "repeated key", 2), (2, "a", "null v", 1), (None, "a", "null k", 2)}
    assert sorted(tuple(r) for r in tb.read_checked(spark, root).collect()) == [(1, "a", 5), (1, "b", 6)]
    assert tb.materialize_checked(make([]), root, **keys).accepted  # an empty table breaks no rule
    assert tb.read_checked(spark, root).collect() == []


@pytest.mark.parametrize("n", [0, 1, 37, 250, 299, 300, 1000])
def test_large_limit_takes_the_first_rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, -1.5, 0.0, 2.25, 1e9]), rng.choice([None, 1, 2**60, 2**60 + 1, -2**60]),
             i % 50) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b long, c int").repartition(5)
    got = fr.limit_large(df, n, ("a", False), ("b", True), ("c", True)).collect()
    want = df.orderBy(F.desc("a"), "b", "c").limit(n).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_large_limit_sorts_nothing(spark):
    li = tb.table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = fr.limit_large(li, 2000, ("l_extendedprice", False), ("l_orderkey", True), ("l_linenumber", True))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan


def test_sample_is_the_same_under_any_partitioning(spark):
    df = spark.range(4000).withColumn("k", F.col("id"))
    one = sm.sample_with_replacement(df.repartition(3), 0.7, 9, key="k")
    two = sm.sample_with_replacement(df.repartition(11, "k"), 0.7, 9, key="k")
    first = Counter(r["k"] for r in one.collect())
    assert first == Counter(r["k"] for r in two.collect()) and one.columns == df.columns
    assert abs(sum(first.values()) - 2800) < 4 * 2800 ** 0.5 and max(first.values()) > 2
    other = Counter(r["k"] for r in sm.sample_with_replacement(df, 0.7, 10, key="k").collect())
    assert other != first
    assert sm.sample_with_replacement(df, 0.0, 9, key="k").count() == 0


def test_repeated_keys_do_not_stop_a_stream(spark):
    lines = ['{"a":"1","z":"1","z":"2"}', '{"a":"1","a":"7"}', '{"a":"1","b":"x","b":"5"}', '{"a":"2"}',
             '{"z":"1","a":"3","z":"1"}', "not json", '{"a":"4","y":{"q":1,"q":2}}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    got = [tuple(r) for r in ing.parse_json_lines(df, schema).collect()]
    assert got[:6] == [(1, None, '{"z":"2"}'), (7, None, None), (1, 5, None), (2, None, None),
                       (3, None, '{"z":"1"}'), (None, None, '{"_raw":"not json"}')]
    assert got[6][0] == 4
