"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job of this library wants. Sizes are left to the cluster, except
# that AQE is allowed to split skewed join partitions and merge small ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # To count the keys held, each write to the store would first read.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Rows may be long texts: ten thousand of them, Spark's own number, are much for a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable defaults on a session somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
