"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# All timestamps are instants read in UTC; overflowing exact integers must raise.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed state is kept off the heap; transformWithState asks for it.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "statelake") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STATELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_PRIVATE_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``; a private folder is made
    only where that is unset (tests on one machine).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _PRIVATE_DIRS:
        _PRIVATE_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="statelake-")
    return _PRIVATE_DIRS[context.applicationId]
