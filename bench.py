"""Headline timings: runs the main plans at $BENCH_SF_DIR on local[$BENCH_CPUS]
and prints one JSON line.  Each query is executed fully with the ``noop``
sink (every row produced, nothing collected to the driver), once, after one
warm-up run of the same query on sf0.001."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from twinreach.plans.catalog import QUERIES  # noqa: E402
from twinreach.session import get_session  # noqa: E402

HEADLINE = [
    "silver",            # bronze strings -> declared types
    "features",          # three whole-population percent ranks + recency/churn/revenue
    "kpi",               # features + impressions -> one KPI row
    "expect_report",     # quality rules, one pass
    "label_audience",    # audience left-join distinct seed
    "hash_split",
    "undersample",       # exact per-class undersampling
    "ingest_conformed",  # JSON files -> stream ingest -> conform
    "pct_lineitem",      # three distributed percent ranks over all lineitem rows
    "gbt_score",         # checkpoint, fit preparation + GBT, score test side
    "positives",         # fit + score whole audience, keep positives
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra_conf={"spark.driver.memory": "16g"})
    # steady state: every timed code path runs once on the smallest data set
    # first (class loading, JIT), so timings are not dominated by warm-up
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
