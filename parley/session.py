"""Session helpers.

Library code never creates a session: it takes the one it is given.  The
builder here is for tests, the benchmark and the command line, and it only
fills in settings that the cluster has not already set.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job wants regardless of scale.  Spark decides the rest
# (shuffle partitions are coalesced at runtime by AQE).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Large audio / text payloads: keep Arrow batches bounded in rows and bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Remove reliable-checkpoint files once their DataFrames are released.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "parley",
                  shuffle_partitions: int | None = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a cluster without one is a configuration error, because a
    machine-local folder would not survive the loss of that machine.  Only
    a local-mode session (unit tests) with nothing configured gets a fresh
    scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver context; the server's conf decides
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="parley-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
