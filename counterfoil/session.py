"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Day boundaries and zone-less texts follow the session zone, so it is pinned.
# Skewed join sides (one event linked by very many transactions) are split by
# adaptive execution, and sides that turn out small per partition are hashed
# instead of sorted.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Keeps the state of streams on disk instead of in the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Not settable later: plans with hundreds of expressions are built several times
# faster when Python does not record the call site of each.
START_CONF = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "counterfoil", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="counterfoil-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session (tests) that names none gets a temporary folder; on a
    cluster such a folder would not be visible to the other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
