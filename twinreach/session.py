"""Session construction and the shared scratch location.

Library code never picks a machine-local folder on its own: intermediate
tables, stream checkpoints and published snapshots go under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is empty
(local runs, tests) is a private folder created and registered; on a cluster
it must be set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for scale: AQE re-plans joins and coalesces partitions at runtime,
# skew join splits hot partitions, and the session zone is pinned so that
# date <-> epoch conversions do not depend on where the driver runs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no _SUCCESS markers in sink folders (replaces deleting them afterwards)
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


def get_session(master: str | None = None, app: str = "twinreach",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering a private one only
    when the session has none (local runs and tests)."""
    current = None
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - e.g. a Connect session
        pass
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(current)
        except Exception:  # pragma: no cover
            pass
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="twinreach-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "twinreach", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df, rebalance: bool = False):
    """Write ``df`` as a parquet table under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a scan of it (eager).

    The lineage is cut: a lost executor re-reads the table instead of
    recomputing the plan, and the planner sees the table's real size.
    Parquet rather than ``DataFrame.checkpoint`` (Java-serialised rows):
    columnar, compressed, vectorised to read.  With ``rebalance`` the rows
    are dealt out evenly, whatever their keys, and AQE sizes the files by
    bytes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so later
    iterative readers run one task per reasonably sized block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "lineage")
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return spark.read.parquet(path)
