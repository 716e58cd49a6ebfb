"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. Event-time semantics need
# UTC; the adaptive settings let Spark split skewed join partitions even where
# that costs an extra exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

DEFAULT_PARTITIONS = "200"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    context, partitions = spark.sparkContext, "spark.sql.shuffle.partitions"
    chosen = context.getConf().get(partitions) or spark.conf.get(partitions) != DEFAULT_PARTITIONS
    if context.master.startswith("local[") and not chosen:
        # Streams keep one state store per partition; a local run needs few. A number that
        # somebody has set stays, and so does every setting of a cluster.
        spark.conf.set(partitions, str(context.defaultParallelism))
    return spark


def build_session(master: str, shuffle_partitions: int, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("murmur")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Scratch folders of local sessions that name none, by application.
LOCAL_ROOTS: dict[str, str] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may fall back to a folder of this machine, one per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        application = spark.sparkContext.applicationId
        if application not in LOCAL_ROOTS:
            LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="murmur-")
        root = LOCAL_ROOTS[application]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
