"""Behavioural features of the audience (the feature table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.functions.columns import (
    CHURN_DAYS,
    PRICES_AS_PUBLISHED,
    churn_flag,
    days_since,
    subscription_revenue,
)
from twinreach.operators.ranking import global_percent_ranks

# Source column -> percentile column.
PERCENTILES = {
    "ad_interaction_rate": "ad_interaction_percentile",
    "avg_daily_watch_time": "avg_daily_watch_percentile",
    "subscription_length": "subscription_length_percentile",
}


def lal_features(silver: DataFrame, as_of=None, prices=PRICES_AS_PUBLISHED,
                 churn_days: int = CHURN_DAYS,
                 buckets: int | None = None, percentiles: dict[str, str] | None = None) -> DataFrame:
    """Silver audience -> feature table.

    Adds population percent ranks of ad rate, watch time and subscription
    length; days since the last session (relative to ``as_of``, default
    today); the churn flag; and the monthly subscription revenue by tier.
    Percentiles of columns the input lacks are skipped; ``percentiles`` names
    others than the three (an empty one computes none, for callers that read
    none: the ranks are written tables, which column pruning cannot drop).
    """
    wanted = PERCENTILES if percentiles is None else percentiles
    ranks = {s: o for s, o in wanted.items() if s in silver.columns}
    out = global_percent_ranks(silver, ranks, buckets)
    return (out
            .withColumn("days_since_last_session", days_since("last_login_date", as_of).cast("int"))
            .withColumn("is_churn", churn_flag("days_since_last_session", churn_days))
            .withColumn("monthly_subscription_revenue", subscription_revenue("subscription_type", prices)))
