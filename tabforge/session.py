"""Session helpers: a local session for tests/bench and the checkpoint folder rule.

On a cluster the session comes from the caller; we only *read* its settings.
A checkpoint folder is set here only when the session has none and runs in
local mode (tests, bench); a cluster must name a shared folder in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster (applied by the cluster's launcher, not here).
# Sized for ~100 TB inputs on ~1000 executors with ~8-16 GB per core:
CLUSTER_CONF = {
    # AQE re-plans on measured sizes: broadcast small join sides, split skewed
    # partitions of inner/left joins, coalesce small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # ~256 MB per shuffle partition after coalescing; start high so the first
    # stage of a 100 TB shuffle is ~400k partitions of <=256 MB each.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "400000",
    # 256 MB scan splits: ~400k scan tasks over 100 TB of Parquet.
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    # runtime broadcast only for small measured sides (AQE), never by estimate
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    # survive executor loss: shuffle files outlive executors
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabforge") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset.

    Order: an already-set SparkContext folder, then ``spark.checkpoint.dir``
    from the session conf, then (local mode only) a fresh folder under the
    system temp dir. A non-local master without a configured folder is an
    error: machine-local folders do not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="tabforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A stable sub-folder of the shared checkpoint folder for written tables.

    Uses the configured ``spark.checkpoint.dir`` itself (stable across
    applications, so materialised tables and stream checkpoints are found
    again on restart) and falls back to the context's checkpoint folder.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or ensure_checkpoint_dir(spark))
    return f"{base.rstrip('/')}/tabforge/{name}"
