"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it turns a shuffled join into a broadcast
# only after measuring the small side, splits skewed join partitions, and sizes
# write partitions. The join hints in this package rely on it instead of broadcast().
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass SETTINGS to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("careledger")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        checkpoint_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = checkpoint_dir.get() if checkpoint_dir.isDefined() else None
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="careledger-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
