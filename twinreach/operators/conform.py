"""Typing of raw (all-string) records against declared schemas, and key checks.

All of it is narrow (no shuffle) except ``key_report``, which groups by key
with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"

# The declared audience schema (silver table), in declared order.
AUDIENCE_SILVER_DDL = """
ad_interaction_rate float,
age_group string,
avg_daily_watch_time double,
binge_watching string,
content_sharing string,
education_level string,
email string,
ethnicity string,
favorite_genre string,
gender string,
home_ownership string,
household_income string,
language_preference string,
last_login_date date,
location string,
marital_status string,
name string,
num_children int,
occupation string,
preferred_viewing_time string,
primary_device string,
subscription_length double,
subscription_type string,
user_id string not null
"""

# Columns the feature table adds, in declared order.
FEATURE_COLUMNS_DDL = """
ad_interaction_percentile double,
avg_daily_watch_percentile double,
subscription_length_percentile double,
days_since_last_session int,
is_churn int,
monthly_subscription_revenue double
"""

# The ad impression record (26 fields).
IMPRESSION_DDL = """
Timestamp string, ImpressionID string, CampaignID string, CreativeID string,
PublisherID string, PlacementID string, UserID string, DeviceType string,
IPAddress string, GeographicLocation string, AdUnitSize string,
BidPrice double, WinningPrice double, ViewabilityScore double,
CompletionRate double, ClickThrough bigint, AudienceSegmentID string,
ContentID string, ContentType string, AdBreakID string, PodPosition bigint,
AdType string, SubscriptionType string, AdDuration bigint, UserAge bigint,
UserGender string
"""

SEED_DDL = "user_id_seed string"
DATE_FORMAT = "yyyy-MM-dd"


_TYPES = {"string": T.StringType(), "float": T.FloatType(), "double": T.DoubleType(),
          "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType()}


def ddl_schema(ddl: str) -> T.StructType:
    """``name type [not null]`` entries, comma separated, of simple types.

    Built without a session (module import time), so only the types above.
    """
    fields = []
    for entry in ddl.split(","):
        words = entry.split()
        nullable = not (len(words) == 4 and words[2].lower() == "not")
        fields.append(T.StructField(words[0], _TYPES[words[1].lower()], nullable))
    return T.StructType(fields)


AUDIENCE_SILVER_SCHEMA = ddl_schema(AUDIENCE_SILVER_DDL)
FEATURES_SCHEMA = T.StructType(AUDIENCE_SILVER_SCHEMA.fields + ddl_schema(FEATURE_COLUMNS_DDL).fields)
IMPRESSION_SCHEMA = ddl_schema(IMPRESSION_DDL)
SEED_SCHEMA = ddl_schema(SEED_DDL)


def all_strings(schema: T.StructType) -> T.StructType:
    """The schema with every field typed string (how raw JSON is ingested)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def as_strings(df: DataFrame) -> DataFrame:
    """Every column cast to string (bronze stand-in for an in-memory frame)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _typed(name: str, source_type: T.DataType, target: T.DataType, strict: bool,
           date_format: str):
    c = F.col(name)
    if isinstance(target, T.DateType) and isinstance(source_type, T.StringType):
        return (F.to_date(c, date_format) if strict else F.try_to_date(c, date_format))
    if source_type == target:
        return c
    return c.cast(target) if strict else c.try_cast(target)


def conform(df: DataFrame, schema: T.StructType = AUDIENCE_SILVER_SCHEMA,
            missing: str = "drop", strict: bool = False,
            date_format: str = DATE_FORMAT) -> DataFrame:
    """Type raw records to a declared schema, in declared order.

    Strings become numbers by cast and dates by ``to_date(col, date_format)``.
    ``strict=False`` (default) turns unparsable text into null (``try_cast``),
    ``strict=True`` raises on it (ANSI cast).  The rescue column and any
    undeclared column are dropped.  ``missing``: 'drop' skips declared columns
    the input lacks, 'null' adds them as typed nulls, 'error' raises.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name in types:
            cols.append(_typed(field.name, types[field.name], field.dataType, strict,
                               date_format).alias(field.name))
        elif missing == "null":
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif missing == "error":
            raise ValueError(f"declared column {field.name!r} is missing")
    return df.select(*cols)


def drop_rescued(df: DataFrame, name: str = RESCUED) -> DataFrame:
    """Drop the rescue column (no error when it is absent)."""
    return df.drop(name)


def key_report(df: DataFrame, key: str = "user_id") -> DataFrame:
    """One row: rows, null keys, distinct non-null keys, keys seen more than
    once and the rows those repeated keys occupy.

    The per-key counts are a partial (map-side) aggregation, so a hot key
    costs one row per task before the shuffle.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    k = F.col(key)
    return per_key.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(k.isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        F.count(k).cast("long").alias("distinct_keys"),
        F.count_if(k.isNotNull() & (F.col("_n") > 1)).cast("long").alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(k.isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0))
         .cast("long").alias("duplicate_rows"),
    )
