"""The feature pipeline: landing files -> bronze -> silver -> features -> KPI.

Each stage is a DataFrame -> DataFrame function; the runner materialises
every stage table under ``root`` (shared storage) so the next stage reads a
table, not a recomputed lineage.  Bronze is incremental (file streams with
``availableNow``); the downstream tables are recomputed from bronze per run.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from twinreach.functions.columns import PRICES_AS_PUBLISHED
from twinreach.operators import conform as cf
from twinreach.operators import quality as ql
from twinreach.operators.features import lal_features
from twinreach.operators.kpi import kpi
from twinreach.sources.tables import materialize
from twinreach.streaming.ingest import add_columns, ingest_json_stream, kept_schema, read_bronze


@dataclass
class PipelineTables:
    bronze_audience: DataFrame
    bronze_seed: DataFrame
    bronze_impressions: DataFrame
    silver: DataFrame
    features: DataFrame
    kpi: DataFrame
    expectations: Observation | None


def _bronze(spark: SparkSession, landing: str, root: str, name: str, strings: bool,
            schema=None) -> DataFrame:
    """Bronze rows so far.  A table that was begun under an inferred schema
    adopts declared columns it lacks."""
    store = os.path.join(root, "schemas", name)
    kept = kept_schema(spark, landing, store, strings, schema)
    if schema is not None and not set(schema.names) <= set(kept.names):
        kept = add_columns(spark, store, schema)
    target = os.path.join(root, "bronze", name)
    ingest_json_stream(spark, landing, target, os.path.join(root, "_checkpoints", name), kept)
    return read_bronze(spark, target, kept)


def run_feature_pipeline(spark: SparkSession, landing: dict[str, str], root: str,
                         rules: dict[str, str] | None = None, as_of=None,
                         prices=PRICES_AS_PUBLISHED, expectation_action: str = "warn") -> PipelineTables:
    """Run every stage once.

    ``landing`` maps 'audience', 'seed' and 'impressions' to JSON folders.
    Every table has its declared schema, whatever the first landing brings.
    ``rules`` (name -> constraint) are applied to silver with
    ``expectation_action`` ('warn' keeps every row and counts failures).
    """
    bronze_a = _bronze(spark, landing["audience"], root, "audience_data", strings=True,
                       schema=cf.all_strings(cf.AUDIENCE_SILVER_SCHEMA))
    bronze_s = _bronze(spark, landing["seed"], root, "seed_data", strings=False,
                       schema=cf.SEED_SCHEMA)
    bronze_i = _bronze(spark, landing["impressions"], root, "ad_impressions", strings=False,
                       schema=cf.IMPRESSION_SCHEMA)

    silver = cf.drop_rescued(cf.conform(bronze_a, cf.AUDIENCE_SILVER_SCHEMA, missing="null"))
    obs = None
    if rules:
        silver, obs = ql.apply_expectations(silver, rules, expectation_action, "audience_data_silver")
    silver = materialize(silver, os.path.join(root, "audience_data_silver"),
                         cf.AUDIENCE_SILVER_SCHEMA)

    features = materialize(lal_features(silver, as_of=as_of, prices=prices),
                           os.path.join(root, "lal_features"), cf.FEATURES_SCHEMA)
    kpi_table = materialize(kpi(features, bronze_i), os.path.join(root, "kpi_data"))
    return PipelineTables(bronze_a, bronze_s, bronze_i, silver, features, kpi_table, obs)
