"""Session construction and shared scratch locations.

Everything that has to land on storage (JSON round trips, streaming
checkpoints, lineage cuts in iterative operators) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  Only on a local master without
that setting (tests, notebooks) do we create a temporary folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings this library is tuned for.  On a cluster they are
# normally provided by the job submission; ``local_session`` applies them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # keeps stream state on disk instead of in the executors' heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tidewash") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session (or the directory already
    registered on the SparkContext).  On a local master without either, a
    fresh temporary folder is used; on a cluster that is an error, as each
    executor would write to its own disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    registered = sc.getCheckpointDir()
    if registered:
        # setCheckpointDir appends a per-application child folder; use its parent
        return registered.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tidewash-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidewash-scratch/{name}-{uuid.uuid4().hex[:12]}"
