"""Incremental ingest: each file once, strings at bronze, rescued fields."""

from pyspark.sql import functions as F

from twinreach.operators.conform import RESCUED, all_strings, conform
from twinreach.session import scratch_path
from twinreach.sources import fixtures as fx
from twinreach.sources.tables import write_json
from twinreach.streaming import ingest as ing

from conftest import SF_SMALL


def test_second_run_adds_nothing_and_new_file_is_read_once(spark):
    a = fx.audience(spark, SF_SMALL)
    land, target, ckpt = (scratch_path(spark, n) for n in ("land", "bronze", "ckpt"))
    write_json(a, land)
    schema = ing.infer_json_schema(spark, land, strings=True)
    assert all(f.dataType.simpleString() == "string" for f in schema.fields)
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    n1 = spark.read.parquet(target).count()
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    assert spark.read.parquet(target).count() == n1 == 150
    write_json(a.limit(10), land)
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    assert spark.read.parquet(target).count() == n1 + 10


def test_bronze_strings_conform_back_to_types(spark):
    a = fx.audience(spark, SF_SMALL)
    land, target, ckpt = (scratch_path(spark, n) for n in ("land", "bronze", "ckpt"))
    write_json(a, land)
    ing.ingest_json_stream(spark, land, target, ckpt, all_strings(a.schema))
    bronze = spark.read.parquet(target)
    assert bronze.where(F.col(RESCUED).isNotNull()).count() == 0
    typed = conform(bronze, a.schema)
    assert sorted(typed.collect()) == sorted(a.collect())


def test_rescue_mismatch_extra_key_and_garbage(spark):
    lines = spark.createDataFrame([
        ('{"user_id": "1", "num_children": 2}',),
        ('{"user_id": "2", "num_children": "many"}',),
        ('{"user_id": "3", "num_children": 1, "coupon": "X"}',),
        ('not json at all',),
    ], "value string")
    out = {r.user_id: r for r in ing.parse_json_lines(lines, fx_schema()).collect()}
    assert out["1"][RESCUED] is None and out["1"].num_children == 2
    assert out["2"].num_children is None and out["2"][RESCUED] == '{"num_children":"many"}'
    assert out["3"].num_children == 1 and out["3"][RESCUED] == '{"coupon":"X"}'
    assert out[None][RESCUED] == '{"_raw":"not json at all"}'


def fx_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("user_id", T.StringType()),
                         T.StructField("num_children", T.IntegerType())])


def test_later_runs_keep_the_first_schema(spark):
    """A later landing neither changes types nor loses a key; a column
    adopted by an explicit step is filled from the rescue column."""
    from pyspark.sql import types as T

    land, target, ckpt, store = (scratch_path(spark, n) for n in ("land", "bronze", "ckpt", "schema"))
    runs = [[("a", 1)], [("b", 2.5)], [("c", 3)]]
    for i, rows in enumerate(runs):
        df = spark.createDataFrame(rows, "user_id string, n double" if i == 1 else "user_id string, n long")
        write_json(df.withColumn("new", F.lit(i)) if i else df, land)
        schema = ing.kept_schema(spark, land, store)
        assert dict((f.name, f.dataType.simpleString()) for f in schema.fields) == {
            "user_id": "string", "n": "bigint"}
        ing.ingest_json_stream(spark, land, target, ckpt, schema)
    got = {r.user_id: r for r in ing.read_bronze(spark, target, schema).collect()}
    assert (got["a"].n, got["b"].n, got["c"].n) == (1, None, 3)
    assert got["a"][RESCUED] is None and got["b"][RESCUED] == '{"n":"2.5","new":"1"}'
    wide = ing.add_columns(spark, store, T.StructType([T.StructField("new", T.LongType())]))
    assert ing.stored_schema(spark, store) == wide
    assert {r.user_id: r.new for r in ing.read_bronze(spark, target, wide).collect()} == {
        "a": None, "b": 1, "c": 2}
