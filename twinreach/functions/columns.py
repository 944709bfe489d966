"""Column expressions used across the operators.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside the JVM (whole-stage codegen); none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results).
# Monthly price per subscription tier, as published: the third key is spelt
# 'Ftandard', so a 'Standard' subscriber earns 0; every other tier earns 0 too.
PRICES_AS_PUBLISHED = (("Premium", 20), ("Basic", 6.99), ("Ftandard", 12.99), ("Free Trial", 0))
# Same table with the key spelt as the tier is named.
PRICES_CORRECTED = (("Premium", 20), ("Basic", 6.99), ("Standard", 12.99), ("Free Trial", 0))
# Churn: more than this many days since the last session.
CHURN_DAYS = 14
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.to_date(F.lit(as_of))


def epoch_seconds(c) -> Column:
    """Date -> seconds since 1970-01-01 at UTC midnight, as bigint.

    Built from ``unix_date`` so the result does not depend on the session
    time zone (``unix_timestamp`` of a date uses the session zone).
    """
    return (F.unix_date(_col(c)).cast("long") * F.lit(86400)).cast("long")


def days_since(c, as_of=None) -> Column:
    """Whole days between the date and ``as_of`` (default: today), unsigned."""
    return F.abs(F.date_diff(_col(c), _date_lit(as_of)))


def churn_flag(days, threshold: int = CHURN_DAYS) -> Column:
    """1 when more than ``threshold`` days passed, else 0 (null days -> 0)."""
    return F.when(_col(days) > threshold, F.lit(1)).otherwise(F.lit(0)).cast("int")


def subscription_revenue(tier, prices=PRICES_AS_PUBLISHED) -> Column:
    """Monthly revenue by tier; tiers not in ``prices`` earn 0. Double."""
    expr = None
    for name, price in prices:
        cond = _col(tier) == F.lit(name)
        value = F.lit(float(price))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(F.lit(0.0)).cast("double")


def md5_bucket(c, salt: str = "") -> Column:
    """First 32 bits of md5(salt || text) as a non-negative bigint.

    Stable across runs, partitionings and engines: DuckDB gives the same
    number with ``('0x' || substr(md5(s), 1, 8))::BIGINT``.  A null counts as
    the empty text, so null keys fall on both sides of a split as one key does.
    """
    text = F.concat(F.lit(salt), F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash60(c, salt: str = "") -> Column:
    """First 60 bits of md5(salt || text) as a non-negative bigint; a null
    counts as the empty text."""
    text = F.concat(F.lit(salt), F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def positive_probability(c="probability") -> Column:
    """Second element of a Spark ML probability vector, as double."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_col(c)).getItem(1).cast("double")
