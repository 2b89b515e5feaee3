"""Session factory, runtime settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. They are runtime SQL settings, so they can
# also be applied to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Split hot partitions after a rebalance hint (partitioned writes).
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state outside the heap; checkpoints hold changes, not copies.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and sizes such as shuffle partitions come from spark-submit on
    a cluster; tests and the bench pass them here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


# Adaptive execution joins small shuffle partitions up to this size. Sorted rows take some twenty times as much memory
# as their compressed bytes, and Spark's own 64 MB made tasks of more than a gigabyte.
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ADVISORY_BYTES = 16 << 20
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def size_in_bytes(size: str) -> int:
    """Bytes of a size as Spark's settings have it, such as 64MB, 8m or 1024."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; a smaller advisory size stays."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if size_in_bytes(spark.conf.get(_ADVISORY)) > ADVISORY_BYTES:
        spark.conf.set(_ADVISORY, str(ADVISORY_BYTES))
    return spark


_local_root: str | None = None


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session may fall back to a temporary folder of its own, because there the
    driver and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the work root that no other run uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
