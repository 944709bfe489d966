"""Percent rank over a whole table.

``percent_rank().over(Window.orderBy(c))`` without a partition moves every
row into one task.  The distributed form is the only one here; it computes,
for each distinct value, how many rows sort strictly before it:

1. ``groupBy(value).count()``: map-side partial aggregation, so a value held
   by a third of all rows is one row after the first stage.
2. The distinct values are range-partitioned (Spark samples the bounds),
   sorted and written with their place, in their own type.  Values keep
   their type throughout: large integers, decimals, dates and strings rank
   as they compare.
3. Inside each range a running sum gives the rows before a value; totals of
   the ranges (at most ranges + columns rows) give each range's offset.
4. ``percent_rank = below / (n - 1)`` (0 when n <= 1) goes back by the value,
   null-safely, to narrow (row, column, value) rows: frequent values by a
   broadcast, all others by a shuffle in which no value has many rows.  The
   ranks are joined to the wide table by row, a column at a time.

Columns of one type share every step above; smaller numbers are widened to
``bigint`` or ``double`` first, which keeps every value.  Nulls sort first (Spark's
ascending default).  Results equal the built-in exactly, ties included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.session import cut_lineage

_ROW, _C, _V, _N, _AT, _RANGE, _P = "_pr_row", "_pr_c", "_pr_v", "_pr_n", "_pr_at", "_pr_range", "_pr_p"

FREQUENT = 10_000  # rows of a value that is joined without moving them

# exact widenings, so that more columns share a pass
WIDENED = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


def value_ranks(pairs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``_pr_c, _pr_v, _pr_n, _pr_p`` for (column number, value) rows: how often
    every distinct value occurs and its percent rank among its column's rows, in
    a written table.
    ``buckets`` is the number of ranges (by default Spark's choice)."""
    counts = pairs.groupBy(_C, _V).agg(F.count(F.lit(1)).alias(_N))
    spread = (counts.repartitionByRange(buckets, _C, _V) if buckets
              else counts.repartitionByRange(_C, _V))
    # upper bits: the range's number, lower bits: the place in it
    placed = cut_lineage(spread.sortWithinPartitions(_C, _V)
                         .withColumn(_AT, F.monotonically_increasing_id()))
    placed = placed.withColumn(_RANGE, F.shiftright(_AT, 33))
    earlier = Window.partitionBy(_C).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(_C)
    totals = placed.groupBy(_C, _RANGE).agg(F.sum(_N).alias("_pr_in"))
    totals = totals.select(_C, _RANGE,
                           F.coalesce(F.sum("_pr_in").over(earlier), F.lit(0)).alias("_pr_before"),
                           F.sum("_pr_in").over(whole).alias("_pr_all"))
    inside = Window.partitionBy(_C, _RANGE).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_pr_before") + F.coalesce(F.sum(_N).over(inside), F.lit(0))
    # one row per range and column
    ranked = placed.join(F.broadcast(totals), [_C, _RANGE])
    return cut_lineage(ranked.select(
        _C, _V, _N, F.when(F.col("_pr_all") <= 1, F.lit(0.0)).otherwise(
            below.cast("double") / (F.col("_pr_all") - 1).cast("double")).alias(_P)))


def global_percent_ranks(df: DataFrame, columns: dict[str, str],
                         buckets: int | None = None) -> DataFrame:
    """``percent_rank()`` over the whole table for each ``{source: output}``
    column (ascending, nulls first), without a single-partition step.

    The input is written once to the shared checkpoint folder with a row
    number, so that the numbers hold for both the ranks and the rows.
    """
    if not columns:
        return df
    wide = cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()))
    kinds: dict[str, list[str]] = {}
    for source in columns:
        kind = wide.schema[source].dataType.simpleString()
        kinds.setdefault(WIDENED.get(kind, kind), []).append(source)
    number = {source: i for i, source in enumerate(columns)}
    found = None
    for kind, sources in kinds.items():
        pairs = wide.select(_ROW, F.explode(F.array(*[
            F.struct(F.lit(number[c]).alias(_C), F.col(c).cast(kind).alias(_V)) for c in sources])).alias("_pr_s")
        ).select(_ROW, "_pr_s.*")
        ranks = value_ranks(pairs.select(_C, _V), buckets).select(
            F.col(_C).alias("_pr_d"), F.col(_V).alias("_pr_w"), _N, _P)
        same = (F.col(_C) == F.col("_pr_d")) & F.col(_V).eqNullSafe(F.col("_pr_w"))
        # rows of a frequent value, one in FREQUENT pairs at most, stay where they are
        tried = pairs.join(F.broadcast(ranks.where(F.col(_N) >= FREQUENT).drop(_N)), same, "left")
        rest = tried.where(F.col(_P).isNull()).select(_ROW, _C, _V).join(
            ranks.where(F.col(_N) < FREQUENT).drop(_N), same)
        for part in (tried.where(F.col(_P).isNotNull()), rest):
            part = part.select(_ROW, _C, _P)
            found = part if found is None else found.unionByName(part)
    # an output that replaces a column of the same name takes its place
    kept = [c for c in df.columns if c not in columns.values()]
    out = wide.select(_ROW, *kept)
    # rows are sorted once, and sorting spills; a map-side table of rows would
    # grow with the input's files
    for source, i in number.items():
        out = out.join(found.where(F.col(_C) == i).select(_ROW, F.col(_P).alias(columns[source])), _ROW)
    return out.drop(_ROW)


def global_percent_rank(df: DataFrame, col: str, out: str, buckets: int | None = None) -> DataFrame:
    """Single-column form of ``global_percent_ranks``."""
    return global_percent_ranks(df, {col: out}, buckets)
