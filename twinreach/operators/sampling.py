"""Sampling and splits.

``hash_split`` and ``undersample`` depend only on the key and a seed (md5),
so they give the same rows on any partitioning, after executor loss and in
DuckDB.  ``sample`` / ``randomSplit`` are Spark's own and depend on
partitioning; they are kept for parity with the reference.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.functions.columns import hash60, md5_bucket

_TWO32 = float(2 ** 32)


def poisson_steps(mean: float) -> list[int]:
    """The Poisson distribution function in units of 2**-60, as far as it is
    below one: a 60-bit number u stands for as many draws as steps are <= u."""
    steps, p, total, k = [], math.exp(-mean), 0.0, 0
    while True:
        total += p
        if total >= 1.0 or (k > mean and p < 2.0 ** -60):
            return steps
        steps.append(int(total * 2.0 ** 60))
        k += 1
        p *= mean / k


def sample_with_replacement(df: DataFrame, fraction: float, seed: int, key=None) -> DataFrame:
    """Poisson sample with replacement (rows may repeat).

    With ``key`` the draws of a row depend on the seed and its key alone: the
    60-bit digest of both goes through the inverse Poisson distribution.  The
    sample is the same under any partitioning, after a lost executor and in
    SQL; nothing is shuffled.  Rows that share a key are drawn equally often,
    so repeated rows need a key that tells them apart.  Null keys count as the
    empty text.  Without ``key`` this is Spark's own sample."""
    if key is None:
        return df.sample(withReplacement=True, fraction=fraction, seed=seed)
    def draws(u):
        return sum((F.when(u >= F.lit(s), 1).otherwise(0) for s in poisson_steps(fraction)), F.lit(0))

    # the digest stands once in the plan, as a lambda's argument: as a column it
    # would be copied into each step, and once more into a filter of no draws
    copies = F.transform(F.array(hash60(key, salt=str(seed))), lambda u: F.array_repeat(F.lit(1), draws(u)))
    return df.withColumn("_draw", F.explode(copies.getItem(0))).drop("_draw")


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Spark's ``randomSplit`` (per-partition Bernoulli cuts)."""
    return df.randomSplit(list(weights), seed=seed)


def split_side(key, share: float = 0.7, seed: int = 42):
    """'train' when the md5 bucket of ``seed || key`` is below ``share``."""
    return F.when(md5_bucket(key, salt=str(seed)) < F.lit(int(share * _TWO32)), F.lit("train")) \
            .otherwise(F.lit("test"))


def hash_split(df: DataFrame, key: str = "user_id", share: float = 0.7,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train / test split by key hash: no shuffle, stable, and every copy of
    a key lands on the same side (no leak from train into test)."""
    tagged = df.withColumn("_side", split_side(key, share, seed))
    return (tagged.where(F.col("_side") == "train").drop("_side"),
            tagged.where(F.col("_side") == "test").drop("_side"))


def undersample(df: DataFrame, label: str = "label", key: str = "user_id",
                seed: int = 42, bits: int = 16) -> DataFrame:
    """Random undersampling to the minority class size, exactly.

    Within each class rows are ordered by ``(hash60(seed || key), key)`` and a
    row is kept when fewer than ``k`` rows of its class come before it, ``k``
    being the smallest class count.  Copies of one key tie, so they are kept
    or dropped together; all null keys are one key, which hashes as the empty
    text and sorts first.  Rows without a label are left out.  Without a
    per-class sort of all rows:

    1. the top ``bits`` bits of the uniform hash cut each class into equal
       buckets; their totals, combined on the map side (at most classes x
       2**bits rows are shuffled per task), locate the one that holds the
       k-th row;
    2. only that bucket's rows are aggregated by key and ordered exactly,
       giving one threshold per class;
    3. rows are kept by comparing with their class threshold (a broadcast of
       one row per class), a narrow filter over the input.
    """
    h, b = "_us_h", "_us_b"
    keyed = (df.where(F.col(label).isNotNull()).withColumn(h, hash60(key, salt=str(seed)))
             .withColumn(b, F.shiftright(F.col(h), 60 - bits)))
    buckets = keyed.groupBy(label, b).agg(F.count(F.lit(1)).alias("_us_bn"))
    in_class = Window.partitionBy(label).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    # k = the smallest class total, from the bucket totals already in the plan;
    # the unpartitioned window sees at most classes x 2**bits rows
    k = F.min(F.sum("_us_bn").over(Window.partitionBy(label))).over(Window.partitionBy())
    boundary = (buckets
                .withColumn("_us_before", F.coalesce(F.sum("_us_bn").over(in_class), F.lit(0)))
                .withColumn("_us_k", k)
                .where((F.col("_us_before") < F.col("_us_k"))
                       & (F.col("_us_before") + F.col("_us_bn") >= F.col("_us_k")))
                .select(label, F.col(b).alias("_us_cut"),
                        (F.col("_us_k") - F.col("_us_before")).alias("_us_need")))
    # the filter goes before the shuffle: only the boundary bucket moves
    per_key = (keyed.select(label, b, h, key).join(F.broadcast(boundary), label)
               .where(F.col(b) == F.col("_us_cut"))
               .groupBy(label, "_us_cut", "_us_need", h, key).agg(F.count(F.lit(1)).alias("_us_n")))
    in_bucket = Window.partitionBy(label).orderBy(h, F.col(key).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    thresholds = (per_key
                  .withColumn("_us_prev", F.coalesce(F.sum("_us_n").over(in_bucket), F.lit(0)))
                  .where(F.col("_us_prev") < F.col("_us_need"))
                  .groupBy(label, "_us_cut")
                  .agg(F.max(F.struct(F.col(h), F.col(key))).alias("_us_last")))
    keep = (F.col(b) < F.col("_us_cut")) | (
        (F.col(b) == F.col("_us_cut")) & (F.struct(F.col(h), F.col(key)) <= F.col("_us_last")))
    return (keyed.join(F.broadcast(thresholds), label).where(keep)
            .drop(h, b, "_us_cut", "_us_last"))
