"""twinreach: look-alike audience analytics as Spark DataFrame plans.

Sub-packages:
  sources    - table scans, fixtures derived from the test tables, sinks
  streaming  - incremental file ingest with Structured Streaming
  functions  - column expressions (revenue, churn, recency, hashes, ...)
  operators  - DataFrame -> DataFrame operators (conform, quality, ranks,
               features, KPI, labelling, sampling, preparation, models)
  plans      - the end-to-end plans and the registry of checked queries
"""

__version__ = "0.1.0"
