"""The distributed percent rank equals the built-in single-task window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from twinreach.operators import ranking as rk


def window_form(df, col, out):
    """The built-in form: one task holds all rows."""
    return df.withColumn(out, F.percent_rank().over(Window.orderBy(F.col(col).asc_nulls_first())))


def _compare(spark, values, buckets):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, v double")
    want = {r.id: r.p for r in window_form(df, "v", "p").collect()}
    got = {r.id: r.p for r in rk.global_percent_rank(df, "v", "p", buckets=buckets).collect()}
    assert got == want


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_random_ties_and_nulls(spark, seed, buckets):
    rnd = random.Random(seed)
    values = [None if rnd.random() < 0.1 else float(rnd.randint(0, 30)) for _ in range(400)]
    _compare(spark, values, buckets)


def test_hot_value_holds_a_third(spark):
    rnd = random.Random(5)
    values = [7.0] * 300 + [rnd.random() * 100 for _ in range(600)]
    _compare(spark, values, 8)


def test_single_row_and_all_null(spark):
    _compare(spark, [3.0], 4)
    _compare(spark, [None, None, None], 4)


def test_no_rows_go_to_one_task(spark, tmp_path):
    """The only single-partition exchanges are over totals of ranges."""
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("v"))
    plan = rk.global_percent_rank(df, "v", "p", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "percent_rank" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("kind, values", [
    ("long", [2**53 + i for i in range(4)] + [None, 2**53]),
    ("decimal(38,2)", ["12345678901234567890.01", "12345678901234567890.02", None]),
    ("date", ["2024-01-01", "2024-01-02", "2024-01-01", None]),
    ("string", ["b", "a", "ä", "", None, "a"]),
    ("float", ["NaN", "-0.0", "0.0", "Infinity", "-Infinity", None]),
])
def test_values_rank_in_their_own_type(spark, kind, values):
    rows = [(i, None if v is None else str(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, s string").select("id", F.col("s").cast(kind).alias("v"))
    want = {r.id: r.p for r in window_form(df, "v", "p").collect()}
    assert {r.id: r.p for r in rk.global_percent_rank(df, "v", "p").collect()} == want


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert rk.global_percent_rank(df, "v", "p").collect() == []
    df = spark.createDataFrame([(1, 2.0)] * 3 + [(1, 3.0)], "id long, v double")
    assert sorted(r.p for r in rk.global_percent_rank(df, "v", "p").collect()) == [0.0, 0.0, 0.0, 1.0]


def test_several_columns_in_one_pass_match_the_window(spark):
    rnd = random.Random(11)
    rows = [(i, None if rnd.random() < 0.05 else rnd.random(), float(rnd.randint(0, 5)),
             None if rnd.random() < 0.2 else float(rnd.randint(0, 500)))
            for i in range(700)]
    df = spark.createDataFrame(rows, "id long, a float, b double, c double")
    cols = {"a": "pa", "b": "pb", "c": "pc"}
    want = df
    for source, out in cols.items():
        want = window_form(want, source, out)
    got = rk.global_percent_ranks(df, cols, buckets=5)
    key = lambda r: (r.id, r.pa, r.pb, r.pc)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       buckets=st.integers(1, 6))
def test_property_distributed_equals_window(spark, values, buckets):
    _compare(spark, values, buckets)


def test_frequent_and_rare_values_give_the_builtin_rank_without_an_aggregate_of_rows(spark, monkeypatch):
    monkeypatch.setattr(rk, "FREQUENT", 50)
    rows = [(i, i % 3 if i % 7 else None, float(i) if i % 5 else 1.5) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, a int, b double").repartition(4)
    out = rk.global_percent_ranks(df, {"a": "pa", "b": "pb"})
    # a map-side table with an entry a row grows with the size of the input's files
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [_pr_row" in line]
    want = df.select("id", *[F.percent_rank().over(Window.orderBy(c)).alias(p) for c, p in (("a", "pa"), ("b", "pb"))])
    assert {r["id"]: (r["pa"], r["pb"]) for r in out.collect()} == {r["id"]: (r["pa"], r["pb"]) for r in want.collect()}
    assert out.count() == 600
