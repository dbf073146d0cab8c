"""Session helpers: a local session for tests/bench and a lineage cut that
survives executor loss (reliable checkpoint in the cluster's shared folder)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "riskweave",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the session
    the platform hands you; nothing in the library depends on these values."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local[N] on small test files: keep partitions small enough that all
        # cores get work (cluster defaults of 64 MB apply unchanged elsewhere)
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``;
    only a local session without that setting gets a scratch folder of its own.
    Returns None when the session exposes no SparkContext (Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (written to the shared checkpoint
    folder, so a lost executor does not force recomputation of the joins).
    Without a SparkContext the session's own checkpoint mechanism is used."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
