"""Projection, set and row-selection helpers on DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinreach.functions.columns import md5_bucket

NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.ShortType,
                 T.ByteType, T.DecimalType)
# Fixed value: helper columns left by indexing / encoding stages.
HELPER_PATTERN = r".*(?:index|vec)$"
DEFAULT_EXCLUDE = ("user_id", "label", "email", "name")


def drop_helper_columns(df: DataFrame, pattern: str = HELPER_PATTERN) -> DataFrame:
    """Drop columns whose name matches ``pattern`` (case-insensitive)."""
    rx = re.compile(pattern, re.IGNORECASE)
    return df.drop(*[c for c in df.columns if rx.match(c)])


def split_columns(schema: T.StructType, exclude=DEFAULT_EXCLUDE) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names: strings vs numbers, minus ``exclude``.

    Ids, labels and personal data are left out by default; pass
    ``exclude=("user_id", "label")`` for the reference's choice.
    """
    cat, num = [], []
    for f in schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
    return cat, num


def align_to(df: DataFrame, columns) -> DataFrame:
    """Keep only the columns of ``df`` that are in ``columns`` (df's order)."""
    wanted = set(columns)
    return df.select(*[c for c in df.columns if c in wanted])


def align_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    return first.unionByName(second, allowMissingColumns=True)


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    """Replace nulls of numeric columns by ``value`` (strings stay null)."""
    return df.fillna(value)


def dedupe_rows(df: DataFrame, subset=None) -> DataFrame:
    """Whole-row (or ``subset``) de-duplication; partial aggregation first."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def override_where(df: DataFrame, cond: Column, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` on rows where ``cond`` holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(cond, v).otherwise(F.col(column)))


def map_column(df: DataFrame, src: str, dst: str, mapping: dict, share: float = 1.0,
               seed: int = 0, key: str = "user_id") -> DataFrame:
    """Set ``dst`` to ``mapping[src]`` on a ``share`` of rows.

    The share is chosen by an md5 bucket of ``seed || key`` (reproducible,
    partitioning-independent); a ``src`` value not in the mapping keeps the
    old ``dst``.  The mapping is a literal map inside the plan.
    """
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col(src)]
    chosen = md5_bucket(key, salt=str(seed)) < F.lit(int(share * 2 ** 32))
    return df.withColumn(dst, F.when(chosen & lookup.isNotNull(), lookup).otherwise(F.col(dst)))


def limit_ordered(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in a given order (distributed top-k: each task keeps
    its best ``n``, one final merge)."""
    return df.orderBy(*order).limit(n)


RANGES = 1024  # ranges of values counted in one scan


def _nth_value(df: DataFrame, column: Column, n: int) -> tuple[object, int]:
    """(v, m): the n-th smallest value of ``column`` (no nulls), and how many
    rows with v are among the first n.  Each scan counts RANGES ranges between
    the least and the largest value and goes on with the one that holds the
    n-th row, so a constant number of rows reaches the driver."""
    rows = df.select(column.alias("v"))
    low, high = rows.agg(F.min("v"), F.max("v")).first()
    while low != high:
        # differences are exact before they are divided; places never fall as values grow
        share = (F.col("v") - F.lit(low)).cast("double") / (F.lit(high) - F.lit(low)).cast("double")
        found = (rows.where(F.col("v").between(F.lit(low), F.lit(high)))
                 .groupBy(F.floor(share * RANGES).alias("at"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
                 .orderBy("at").collect())  # RANGES + 1 rows at most
        for r in found:
            if n <= r["n"]:
                low, high = r["a"], r["b"]
                break
            n -= r["n"]
    return low, n


def limit_large(df: DataFrame, n: int, *order: tuple[str, bool]) -> DataFrame:
    """First ``n`` rows by numeric columns ``(name, ascending)``, for an ``n``
    in the millions: the rows are filtered by a threshold and come back in
    any order, without a sort or a single task.

    The threshold is found column by column: the n-th value of the first one,
    then, among the rows that tie there, the value of the next.  Nulls sort
    first when ascending and last when descending, as in Spark.  Rows that tie
    in all columns are interchangeable; so many of them are taken as are
    missing.
    """
    if n <= 0:
        return df.limit(0)
    keys = []
    for name, ascending in order:
        null = F.col(name).isNull()
        keys.append(F.when(null, 0 if ascending else 1).otherwise(1 if ascending else 0))
        value = F.col(name) if ascending else -F.col(name)
        keys.append(F.when(null, F.lit(0).cast(df.schema[name].dataType)).otherwise(value))
    if n >= df.count():
        return df
    before, tied, left = F.lit(False), F.lit(True), n
    for key in keys:
        value, left = _nth_value(df.where(tied), key, left)
        before = before | (tied & (key < F.lit(value)))
        tied = tied & (key == F.lit(value))
    if df.where(tied).count() == left:
        return df.where(before | tied)
    return df.where(before).unionByName(df.where(tied).limit(left))


def latest_row(df: DataFrame, ts: str, tiebreak: str | None = None) -> DataFrame:
    """The row with the greatest ``ts`` (ties: greatest ``tiebreak``)."""
    order = [F.col(ts).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    return df.orderBy(*order).limit(1)
