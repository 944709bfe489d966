"""Scalar column functions (all JVM-side built-ins)."""

from twinreach.functions.columns import (  # noqa: F401
    CHURN_DAYS,
    PRICES_AS_PUBLISHED,
    PRICES_CORRECTED,
    churn_flag,
    days_since,
    epoch_seconds,
    hash60,
    md5_bucket,
    positive_probability,
    subscription_revenue,
)
