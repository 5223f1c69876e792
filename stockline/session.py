"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Whole-stage codegen emits methods larger than the JIT's 8000-byte
    # limit for wide joins + projections; without this flag they stay
    # interpreted. Launchers on a cluster should pass the same option.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stockline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches. On a cluster the launcher's
    session is used as-is and only the checkpoint folder is resolved."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, sized from the input volume.

    The initial shuffle partition count gives ~``target_partition_bytes``
    per partition for a shuffle as large as the input (AQE then coalesces
    small ones and splits skewed ones), and never fewer than three waves
    of tasks over all cores. Scans split at the same size. Example: 100 TiB
    over 1000 executors × 8 cores → 409,600 shuffle partitions, 24,000-core
    floor, 256 MB splits.
    """
    parts = max(3 * executor_cores, -(-input_bytes // target_partition_bytes))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # runtime broadcast only below a measured size
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there (or on the SparkContext) and we
    only read it. Only when it is unset on a local session (tests) do
    we create a scratch folder and register it; on a cluster that is an
    error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - remote session or older API
            path = None
    if not path:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a shared folder in spark.checkpoint.dir; only a local session makes its own")
        path = tempfile.mkdtemp(prefix="stockline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - read-only core conf in this session
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote session
        pass
    return path


def state_root(spark: SparkSession, name: str) -> str:
    """A folder for versioned state under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/state/{name}"
