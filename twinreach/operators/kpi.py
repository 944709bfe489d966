"""Business indicators: churned users, subscription and ad revenue.

One plan, no driver round trip: each input is reduced to one row with
map-side partial aggregation, the two rows are stacked and folded into the
KPI row.  Money is summed as a wide decimal, so amounts below a cent count
and the total does not depend on summation order; only the total is cast, to
the declared ``float``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"


def churn_count(features: DataFrame, churn_col: str = "is_churn") -> DataFrame:
    """Rows with the churn flag set, and all rows (one row)."""
    return features.agg(F.count_if(F.col(churn_col) == 1).cast("long").alias("churned_users"),
                        F.count(F.lit(1)).cast("long").alias("n_users"))


def kpi(features: DataFrame, impressions: DataFrame, churn_col: str = "is_churn",
        revenue_col: str = "monthly_subscription_revenue",
        price_col: str = "WinningPrice") -> DataFrame:
    """``churned_users int, sub_revenue float, ad_revenue float`` (one row).

    A sum over no rows is null, as in the reference.
    """
    users = features.agg(
        F.count_if(F.col(churn_col) == 1).alias("_churned"),
        F.sum(F.col(revenue_col).cast(MONEY)).alias("_sub"))
    ads = impressions.agg(F.sum(F.col(price_col).cast(MONEY)).alias("_ad"))
    return (users.unionByName(ads, allowMissingColumns=True)
            .agg(F.max("_churned").cast("int").alias("churned_users"),
                 F.max("_sub").cast("float").alias("sub_revenue"),
                 F.max("_ad").cast("float").alias("ad_revenue")))
