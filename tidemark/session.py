"""Session settings, and the shared folder that intermediate tables and stream state are written to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every query relies on; all can be changed while a session runs.
RUNTIME = {
    # NTZ and zoned timestamps only agree with each other under a fixed zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a skewed join partition even where that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a hot key's rows are merged into sessions before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # state on local disk with incremental uploads instead of on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Settings for the sessions built here; a cluster brings its own.
STATIC = {
    "spark.ui.enabled": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle sizes for an input: few enough blocks, partitions that fit a task.

    A shuffle has map tasks times partitions blocks. Up to a few TB the defaults of Spark are fine
    for scans; beyond that scan tasks grow, so that 100 TB is about 100,000 of them. Partitions aim
    at 512 MB of input and adaptive execution merges those that turn out small.
    """
    mb = 1 << 20
    scan = min(1024 * mb, max(128 * mb, input_bytes // 100_000))
    partitions = min(50_000, max(2 * cores, input_bytes // (512 * mb)))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
    }


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is reachable from every executor. Only where that
    is unset and all tasks run on this machine (tests, a laptop) a local one is made, once per
    application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
        base = _local_dirs[app]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
