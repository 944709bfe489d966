"""Table scans and sinks (batch).

Scans are plain ``spark.read`` calls so that Catalyst pushes filters and
column pruning into the parquet reader.  Sinks write through the DataFrame
writer; nothing is collected to the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table of a data folder (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by (possibly multi-part) name."""
    return spark.read.table(name)


def to_schema(df: DataFrame, schema: T.StructType, missing: str = "null") -> DataFrame:
    """Project ``df`` onto a declared schema: declared order, declared types.

    ``missing``: 'null' adds absent columns as typed nulls, 'drop' leaves them
    out, 'error' raises.  Columns not in the schema are dropped.
    """
    have = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name in have:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif missing == "null":
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif missing == "error":
            raise ValueError(f"column {field.name!r} missing from input")
    return df.select(*cols)


def write_json(df: DataFrame, path: str, files: int | None = None, mode: str = "append") -> None:
    """Append JSON files, optionally re-split into ``files`` files.

    With ``files`` set this is a round-robin shuffle (as the source data is
    laid out); without it each input partition writes one file, no shuffle.
    Success markers are suppressed by the session setting
    ``mapreduce.fileoutputcommitter.marksuccessfuljobs=false``.
    """
    out = df.repartition(files) if files else df
    out.write.mode(mode).json(path)


def materialize(df: DataFrame, path: str, schema: T.StructType | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Write a table (optionally conformed to a declared schema) and return a
    scan of what was written, which also cuts the lineage for later stages."""
    out = to_schema(df, schema, missing="error") if schema is not None else df
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_table(df: DataFrame, name_or_path: str, mode: str = "overwrite") -> None:
    """Overwrite sink: a catalog table name, or a folder path (contains '/')."""
    if "/" in name_or_path or ":" in name_or_path:
        df.write.mode(mode).parquet(name_or_path)
    else:
        df.write.mode(mode).saveAsTable(name_or_path)


# -- published snapshots -----------------------------------------------------
# Results for downstream readers, kept with their history.  Each publication
# is a folder of its own, and becomes visible by a row in the manifest, which
# is written last: a publication may be empty, may be repeated, and two
# publishers never write to the same folder.

MANIFEST = "version int, published_at long, folder string, n_rows long, columns string"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per publication under ``root`` (none when there is no manifest)."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Publish ``df`` as version ``version`` under ``root``.

    Other versions are kept.  Publishing a version again replaces it for
    readers, also by a publication without rows.
    """
    spark = df.sparkSession
    folder = f"versions/{int(version)}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{root}/{folder}")
    n = spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()
    row = (int(version), time.time_ns(), folder, n, df.schema.json())
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


@dataclass
class CheckedWrite:
    """What became of a checked write.  ``offences`` has a row per key and
    reason (the key columns, ``reason``, ``rows``)."""

    accepted: bool
    offences: DataFrame


def materialize_checked(df: DataFrame, root: str, key: list[str], not_null: list[str] | None = None,
                        schema: T.StructType | None = None) -> CheckedWrite:
    """Write a table whose key and not-null columns are enforced.

    The rows go to a new folder under ``root`` and are checked there, in one
    aggregation by key; only without an offence does a manifest row make them
    the table that ``read_checked`` finds.  A refused or failed write leaves
    the table as it was.  Key columns must not be null either.
    """
    spark = df.sparkSession
    out = to_schema(df, schema, missing="error") if schema is not None else df
    folder = f"versions/{uuid.uuid4().hex}"
    out.write.parquet(f"{root}/{folder}")
    staged = spark.read.schema(out.schema).parquet(f"{root}/{folder}")
    checked = [*key, *(c for c in not_null or [] if c not in key)]
    by_key = staged.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(checked)])
    reasons = [F.when(F.col(f"_null_{i}") > 0, F.struct(F.lit(f"null {c}").alias("reason"),
                                                         F.col(f"_null_{i}").alias("rows")))
               for i, c in enumerate(checked)]
    reasons.append(F.when((F.col("_rows") > 1) & ~_any_null(key),
                          F.struct(F.lit("repeated key").alias("reason"), F.col("_rows").alias("rows"))))
    found = by_key.select(*key, F.explode(F.filter(F.array(*reasons), lambda r: r.isNotNull())).alias("_r"))
    found.select(*key, "_r.reason", "_r.rows").write.parquet(f"{root}/offences/{folder}")
    offences = spark.read.schema(T.StructType([
        *(out.schema[c] for c in key), T.StructField("reason", T.StringType()),
        T.StructField("rows", T.LongType())])).parquet(f"{root}/offences/{folder}")
    if offences.take(1):
        return CheckedWrite(False, offences)
    row = ((newest_version(spark, root) or 0) + 1, time.time_ns(), folder, staged.count(), out.schema.json())
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return CheckedWrite(True, offences)


def _any_null(columns: list[str]):
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def read_checked(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last accepted write."""
    return read_snapshot(spark, root).drop("version")


def newest_version(spark: SparkSession, root: str) -> int | None:
    """The newest published version, read from the manifest alone."""
    return manifest(spark, root).agg(F.max("version")).first()[0]


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Read one version (the newest when ``version`` is None), with a column
    ``version``.  Only the folder of its last publication is read."""
    rows = manifest(spark, root)
    if version is not None:
        rows = rows.where(F.col("version") == int(version))
    last = rows.orderBy(F.desc("version"), F.desc("published_at")).limit(1).collect()
    if not last:
        raise ValueError(f"{root} has no published version" + (f" {version}" if version else ""))
    schema = T.StructType.fromJson(json.loads(last[0]["columns"]))
    return (spark.read.schema(schema).parquet(f"{root}/{last[0]['folder']}")
            .withColumn("version", F.lit(last[0]["version"]).cast("int")))


def read_as_of(spark: SparkSession, root: str, at: int) -> DataFrame:
    """The rows readers saw at ``at``; a version published again later is read
    as it was then."""
    seen = manifest(spark, root).where(F.col("published_at") <= int(at))
    last = seen.orderBy(F.desc("version"), F.desc("published_at")).limit(1).collect()
    if not last:
        raise ValueError(f"{root} had no published version at {at}")
    schema = T.StructType.fromJson(json.loads(last[0]["columns"]))
    return (spark.read.schema(schema).parquet(f"{root}/{last[0]['folder']}")
            .withColumn("version", F.lit(last[0]["version"]).cast("int")))


def changes(spark: SparkSession, root: str, start: int, end: int) -> DataFrame:
    """The distinct rows of two versions with ``change``: 'added' (in ``end``
    only), 'removed' (in ``start`` only) or 'kept'.  Rows are compared null-safely,
    by one grouping of both versions; both need the same columns."""
    old, new = (read_snapshot(spark, root, v).drop("version") for v in (start, end))
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    sides = both.groupBy(*old.columns).agg(F.min("_new").alias("_first"), F.max("_new").alias("_last"))
    change = (F.when(F.col("_first") == 1, "added").when(F.col("_last") == 0, "removed").otherwise("kept"))
    return sides.select(*old.columns, change.alias("change"))
