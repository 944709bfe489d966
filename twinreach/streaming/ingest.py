"""Incremental JSON ingest with Structured Streaming.

A file stream remembers in its checkpoint which files it has read, so each
run picks up only files added since the last one; ``availableNow`` runs it
as a batch job that stops when it has caught up (the reference's triggered,
non-continuous pipeline).

Records are read as text lines, parsed once with ``from_json`` and cast to
the declared schema.  A field whose text does not fit its declared type, and
any key the schema does not declare, goes to ``_rescued_data`` (a JSON
object of those keys and their raw text) instead of being lost; the rest of
the record keeps its typed values.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinreach.operators.conform import RESCUED

JSON_OPTIONS = {"mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd"}


def infer_json_schema(spark: SparkSession, path: str, strings: bool = False) -> T.StructType:
    """Schema inferred from all files present (the first run reads them all).

    ``strings=True`` types every field as string, the bronze convention for
    the audience; otherwise numbers, booleans and nested values are typed.
    """
    reader = spark.read
    if strings:
        reader = reader.option("primitivesAsString", "true")
    return reader.json(path).schema


# -- stored schema -------------------------------------------------------------
# A bronze table keeps the schema of its first run beside the stream's
# checkpoint.  Later runs neither infer nor read old files: a new key and a
# value that does not fit go to the rescue column, so files written by
# different runs always have the same types.  A new column is added by an
# explicit step, and is then filled from the rescue column for older rows.

SCHEMA_LOG = "version int, columns string"


def stored_schema(spark: SparkSession, store: str) -> T.StructType | None:
    """The newest schema kept in ``store``; None before the first run."""
    try:
        log = spark.read.schema(SCHEMA_LOG).parquet(store)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = log.orderBy(F.desc("version")).first()
    return T.StructType.fromJson(json.loads(last["columns"]))


def store_schema(spark: SparkSession, store: str, schema: T.StructType) -> T.StructType:
    known = stored_schema(spark, store)
    n = 1 if known is None else spark.read.schema(SCHEMA_LOG).parquet(store).count() + 1
    spark.createDataFrame([(n, schema.json())], SCHEMA_LOG).coalesce(1).write.mode(
        "append").parquet(store)
    return schema


def kept_schema(spark: SparkSession, source: str, store: str, strings: bool = False,
                declared: T.StructType | None = None) -> T.StructType:
    """The stored schema; on the first run ``declared`` or what is inferred."""
    known = stored_schema(spark, store)
    if known is not None:
        return known
    return store_schema(spark, store, declared or infer_json_schema(spark, source, strings))


def add_columns(spark: SparkSession, store: str, columns: T.StructType) -> T.StructType:
    """Adopt new columns; a column that is there keeps its type."""
    known = stored_schema(spark, store)
    have = {f.name for f in known.fields}
    return store_schema(spark, store, T.StructType(
        [*known.fields, *(f for f in columns.fields if f.name not in have)]))


def read_bronze(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All runs' rows under ``schema``; a column adopted later is taken from
    the rescue column of the rows before."""
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    rows = spark.read.schema(full).parquet(target)
    rescued = F.from_json(RESCUED, T.MapType(T.StringType(), T.StringType()))
    return rows.select(*[F.coalesce(F.col(f.name), _typed(rescued[f.name], f.dataType)).alias(f.name)
                         for f in schema.fields], RESCUED)


def _typed(text, kind: T.DataType):
    """A field's text as its declared type; null when it does not fit."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind, JSON_OPTIONS)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def _last_of_each_key(entries):
    """A map of text fields whose keys may repeat, with the last value of
    each (what a JSON reader does); maps without a repeated key are kept."""
    keys = F.map_keys(entries)
    rest = F.map_entries(entries)
    later = F.filter(rest, lambda e, i: ~F.array_contains(
        F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys),
                  F.map_from_entries(later)).otherwise(entries)


def parse_json_lines(lines: DataFrame, schema: T.StructType, rescue: bool = True,
                     text_col: str = "value") -> DataFrame:
    """Typed columns of ``schema`` from JSON text lines, plus ``_rescued_data``.

    A line is parsed once, to its keys and their text; fields are cast from
    there, and what is not declared or does not fit is rescued.  Of a key that
    a line repeats, declared or not, the last value counts."""
    source, parsed = F.col(text_col), "_parsed"
    lines = lines.select(source.alias("_raw"), F.from_json(
        source, T.MapType(T.StringType(), T.StringType()), JSON_OPTIONS).alias(parsed))
    lines = lines.select("_raw", _last_of_each_key(F.col(parsed)).alias(parsed))
    typed = {f.name: _typed(F.col(parsed)[f.name], f.dataType) for f in schema.fields}
    cols = [c.alias(name) for name, c in typed.items()]
    if not rescue:
        return lines.select(*cols)
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    none = F.create_map().cast("map<string,string>")
    extra = F.map_filter(parsed, lambda k, v: ~F.array_contains(declared, k))
    bad = [F.when(F.col(parsed)[f.name].isNotNull() & typed[f.name].isNull(),
                  F.struct(F.lit(f.name).alias("key"), F.col(parsed)[f.name].alias("value")))
           for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    unfit = F.map_from_entries(F.filter(F.array(*bad), lambda e: e.isNotNull())) if bad else none
    rescued_map = F.map_concat(unfit, F.coalesce(extra, none))
    rescued = F.when(F.size(rescued_map) > 0, F.to_json(rescued_map))
    # a line that is not JSON at all is rescued whole
    raw = F.col("_raw")
    rescued = F.when(F.col(parsed).isNull() & raw.isNotNull() & (F.trim(raw) != ""),
                     F.to_json(F.create_map(F.lit("_raw"), raw))).otherwise(rescued)
    return lines.select(*cols, rescued.alias(RESCUED))


def ingest_json_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                       schema: T.StructType, rescue: bool = True, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> None:
    """Append the files of ``source`` not yet seen to ``target`` and stop.

    ``checkpoint`` holds the stream's progress (which files were read), so
    re-running reads only new files; it must be on shared storage.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    parsed = parse_json_lines(reader.load(source), schema, rescue)
    q = (parsed.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(target))
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
