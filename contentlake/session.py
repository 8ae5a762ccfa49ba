"""Session settings and the shared folder used for checkpoints and sinks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every contentlake job relies on: adaptive execution (runtime
# broadcast conversion from measured shuffle sizes, partition coalescing and
# skew-join splitting for hot keys) and a UTC session clock.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # static broadcast only below 10 MB of *estimated* size; AQE re-checks
    # with measured sizes at run time
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # Small sides are already broadcast behind checked bounds; the injected
    # runtime bloom filters add 3-12 MB task binaries on the lookup plans and
    # their generated code fails to compile on PySpark 4.1.2 (interpreted
    # fallback), so they are left off.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "contentlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only in local mode, where executors and driver are one
    process, a private folder is made when neither is set; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="contentlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (sinks, stream state)."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Cut lineage: reliably checkpoint ``df`` into the shared checkpoint
    folder (``spark.checkpoint.dir``; survives executor loss, unlike a local
    checkpoint) and continue from the written copy.

    Used between chained table mutations, where each new snapshot would
    otherwise recompute every earlier step."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
