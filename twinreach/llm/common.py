"""Helpers shared by the training-data operators.

Intermediate results that are read more than once are written as Parquet
tables under the folder in ``spark.checkpoint.dir`` (shared by driver and
executors), so a lost executor re-reads a table instead of recomputing, and
ids handed out while a table is written never change afterwards.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinreach.session import scratch_path

# the six ASCII white-space characters, as a regular-expression class
WHITESPACE = r"[\x20\x09-\x0D]"


# rows and bytes of a batch sent to Python; texts are long, and a batch is held
# whole on both sides
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500",
         "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder; return its scan."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {k: spark.conf.get(k) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """``run`` (batches to batches) that gives its memory back when a task
    ends: Python workers are used again, and freed blocks would otherwise stay
    with them beside the next stage's."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add a unique long to every row and store the result, so that the
    numbers stay fixed for every later reader."""
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name)


def ranked_within(df: DataFrame, group: list[str], order: list[str], rank: str,
                  name: str) -> DataFrame:
    """Add ``rank``: 0, 1, 2, ... inside each group by ``order``, without
    putting a whole group into one task.

    Rows are range-partitioned by (group, order, random tie-break), so a
    group with a third of all rows spreads over many partitions.  A row's
    rank is its place in its partition's part of the group plus the sizes of
    the group's parts in earlier partitions.  The table of parts has at most
    (groups + partitions) rows: a part either starts a group or a partition.
    Ties in ``order`` are ranked in an arbitrary, then fixed, order.
    """
    keys = [*group, *order]
    spread = (df.withColumn("_tie", F.rand(11))
              .repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
              .drop("_tie"))
    # upper bits: partition, lower 33 bits: place in the partition
    placed = numbered(spread, "_at", name)
    placed = (placed.withColumn("_part", F.shiftright("_at", 33))
              .withColumn("_place", F.col("_at").bitwiseAND((1 << 33) - 1)))
    parts = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"),
                                                F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = parts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))
                             - F.col("_first"))
    parts = parts.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(group)],
                         F.col("_part").alias("_of"), "_shift")
    on = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(group)]
    joined = placed.join(F.broadcast(parts), [*on, F.col("_part") == F.col("_of")])
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(rank))


def has_rows(df: DataFrame) -> bool:
    """Whether ``df`` has a row."""
    return bool(df.take(1))
