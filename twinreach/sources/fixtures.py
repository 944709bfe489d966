"""Audience, seed, impression and label tables derived from the test tables.

The reference generates its audience with a single-machine simulator; here the
stand-ins are Spark plans over the given ``customer``, ``orders`` and
``events`` tables, so their size grows with the data.  The SQL texts below
define the same tables for the DuckDB oracle (they are run in both engines).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinreach.sources.tables import table

# Fixed date standing in for "today" in fixtures (the last order is 2001-08-01).
AS_OF = dt.date(2001, 8, 2)
AS_OF_SQL = "DATE '2001-08-02'"
# Seed recency cut-off used with the fixtures (about 180 days before AS_OF).
SEED_SINCE = dt.date(2001, 2, 2)

# Fixed values of the seed profile (the reference's seed rule).
SEED_GENRES = ("Comedy", "Documentary", "Reality TV")
SEED_TIERS = ("Free Trial", "Basic", "Standard")
SEED_MIN_WATCH = 60


def audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """11 audience columns per customer (see FIXTURES.md)."""
    c = table(spark, sf_dir, "customer")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"),
             F.max("o_totalprice").alias("max_price"),
             F.max("o_orderdate").alias("last_order"))
    )
    j = c.join(per_customer, c.c_custkey == per_customer.o_custkey, "left")
    key, bal, nation = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    n_orders = F.coalesce(F.col("n_orders"), F.lit(0))
    return j.select(
        key.cast("string").alias("user_id"),
        F.when(bal >= 7500, "Premium").when(bal >= 4000, "Standard")
         .when(bal >= 0, "Basic").otherwise("Free Trial").alias("subscription_type"),
        F.when(key % 37 == 5, F.lit(None).cast("double"))
         .otherwise(F.col("max_price") / 2000).alias("avg_daily_watch_time"),
        (F.abs(bal) / 10000).cast("float").alias("ad_interaction_rate"),
        n_orders.cast("double").alias("subscription_length"),
        (n_orders % 5).cast("int").alias("num_children"),
        F.when(key % 41 == 7, F.lit(None).cast("date"))
         .otherwise(F.col("last_order").cast("date")).alias("last_login_date"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Action")
         .when(F.col("c_mktsegment") == "MACHINERY", "Documentary")
         .when(F.col("c_mktsegment") == "BUILDING", "Comedy")
         .when(F.col("c_mktsegment") == "FURNITURE", "Drama")
         .otherwise("Reality TV").alias("favorite_genre"),
        F.when(nation % 5 == 0, "18-24").when(nation % 5 == 1, "25-34")
         .when(nation % 5 == 2, "35-44").when(nation % 5 == 3, "45-54")
         .otherwise("55+").alias("age_group"),
        F.when(key % 50 == 0, F.lit(None).cast("string"))
         .when(key % 20 == 3, F.col("c_name"))
         .otherwise(F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                             F.lit("@example.com"))).alias("email"),
        F.when(nation % 4 == 0, "M").when(nation % 4 == 1, "F")
         .when(nation % 4 == 2, "Other").otherwise("U").alias("gender"),
    )


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinreach.operators.seed import select_seed

    return select_seed(audience(spark, sf_dir), SEED_GENRES, SEED_TIERS,
                       SEED_MIN_WATCH, since=SEED_SINCE)


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad impressions: view and click events."""
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_type").isin("view", "click"))
             .select(F.col("event_id").cast("string").alias("ImpressionID"),
                     F.col("ts").alias("Timestamp"),
                     F.col("user_id").cast("string").alias("UserID"),
                     F.col("value").alias("WinningPrice"),
                     F.when(F.col("event_type") == "click", 1).otherwise(0)
                      .cast("int").alias("ClickThrough")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from twinreach.operators.seed import label_audience

    return label_audience(audience(spark, sf_dir), seed(spark, sf_dir)).select("user_id", "label")


# ---------------------------------------------------------------------------
# The same tables as SQL text for the DuckDB oracle.

AUDIENCE_SQL = """
SELECT CAST(c.c_custkey AS VARCHAR(20)) AS user_id,
  CASE WHEN c.c_acctbal >= 7500 THEN 'Premium' WHEN c.c_acctbal >= 4000 THEN 'Standard' WHEN c.c_acctbal >= 0 THEN 'Basic' ELSE 'Free Trial' END AS subscription_type,
  CASE WHEN c.c_custkey % 37 = 5 THEN NULL ELSE o.max_price / 2000 END AS avg_daily_watch_time,
  CAST(abs(c.c_acctbal) / 10000 AS FLOAT) AS ad_interaction_rate,
  CAST(coalesce(o.n_orders, 0) AS DOUBLE) AS subscription_length,
  CAST(coalesce(o.n_orders, 0) % 5 AS INT) AS num_children,
  CASE WHEN c.c_custkey % 41 = 7 THEN NULL ELSE CAST(o.last_order AS DATE) END AS last_login_date,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Action' WHEN 'MACHINERY' THEN 'Documentary' WHEN 'BUILDING' THEN 'Comedy' WHEN 'FURNITURE' THEN 'Drama' ELSE 'Reality TV' END AS favorite_genre,
  CASE c.c_nationkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' ELSE '55+' END AS age_group,
  CASE WHEN c.c_custkey % 50 = 0 THEN NULL WHEN c.c_custkey % 20 = 3 THEN c.c_name ELSE concat(lower(replace(c.c_name, '#', '.')), '@example.com') END AS email,
  CASE c.c_nationkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Other' ELSE 'U' END AS gender
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
"""

SEED_SQL = """
SELECT user_id AS user_id_seed FROM audience WHERE favorite_genre IN ('Comedy','Documentary','Reality TV') AND subscription_type IN ('Free Trial','Basic','Standard') AND avg_daily_watch_time > 60 AND last_login_date >= DATE '2001-02-02'
"""

IMPRESSIONS_SQL = """
SELECT CAST(event_id AS VARCHAR(20)) AS ImpressionID, ts AS Timestamp, CAST(user_id AS VARCHAR(20)) AS UserID, value AS WinningPrice, CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS INT) AS ClickThrough FROM events WHERE event_type IN ('view','click')
"""

LABELLED_SQL = """
SELECT a.user_id, CAST(CASE WHEN s.user_id_seed IS NOT NULL THEN 1 ELSE 0 END AS INT) AS label FROM audience a LEFT JOIN (SELECT DISTINCT user_id_seed FROM seed) s ON a.user_id = s.user_id_seed
"""


def with_fixtures(sql: str) -> str:
    """Prefix an oracle query with the fixture tables as CTEs."""
    return ("WITH audience AS (" + AUDIENCE_SQL + "), seed AS (" + SEED_SQL
            + "), impressions AS (" + IMPRESSIONS_SQL + "), labelled AS ("
            + LABELLED_SQL + ")\n" + sql)
