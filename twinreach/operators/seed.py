"""Seed selection and labelling of the audience against a seed list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_seed(audience: DataFrame, genres=None, tiers=None, min_watch=None,
                since=None, as_of=None, window_days: int | None = None,
                key: str = "user_id") -> DataFrame:
    """Ids of the seed profile: ``user_id_seed``.

    Filters on typed columns (compare numbers, not text): favourite genre in
    ``genres``, tier in ``tiers``, watch time above ``min_watch``, last login
    on or after ``since`` (or ``window_days`` before ``as_of``).  Every filter
    is a plain predicate, so Catalyst pushes it into the parquet scan.
    """
    df = audience
    if genres:
        df = df.where(F.col("favorite_genre").isin(list(genres)))
    if tiers:
        df = df.where(F.col("subscription_type").isin(list(tiers)))
    if min_watch is not None:
        df = df.where(F.col("avg_daily_watch_time") > F.lit(float(min_watch)))
    if since is not None:
        if isinstance(since, (dt.date, dt.datetime)):
            since = since.strftime("%Y-%m-%d")
        df = df.where(F.col("last_login_date") >= F.to_date(F.lit(since)))
    elif window_days is not None:
        ref = F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))
        df = df.where(F.col("last_login_date") >= F.date_sub(ref, int(window_days)))
    return df.withColumnRenamed(key, "user_id_seed").select("user_id_seed")


def label_audience(audience: DataFrame, seed: DataFrame, key: str = "user_id",
                   seed_key: str = "user_id_seed", dedupe: bool = True,
                   label: str = "label") -> DataFrame:
    """Left join the audience to the seed ids; ``label`` = 1 on a match.

    ``dedupe=True`` reduces the seed to distinct ids first (partial
    aggregation before the shuffle), so every audience row appears once even
    when seed files were appended twice.  ``dedupe=False`` keeps the plain
    left join, which repeats a row per repeated seed id.  The join strategy
    is left to AQE: a small seed list is broadcast at runtime, a large one is
    sort-merge joined on the key.
    """
    ids = seed.select(F.col(seed_key).alias("_seed_id"))
    if dedupe:
        ids = ids.distinct()
    joined = audience.join(ids, audience[key] == ids["_seed_id"], "left")
    return (joined.withColumn(label, F.when(F.col("_seed_id").isNotNull(), F.lit(1))
                              .otherwise(F.lit(0)).cast("int"))
            .drop("_seed_id"))
