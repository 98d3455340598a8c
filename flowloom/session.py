"""Session defaults the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings every deployment should carry; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # stateful streaming operators keep per-client state outside the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # the Python workers talk over a Unix socket, so no local port is opened for them
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    # wide records make generated methods larger than the JIT compiler takes by default
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # no call-site capture for every Column expression; plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "flowloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULTS`; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "flowloom", cores: int | None = None) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        app,
        master=f"local[{cores}]",
        spark__sql__shuffle__partitions=str(cores),
        spark__driver__memory=os.environ.get("FLOWLOOM_DRIVER_MEMORY", "8g"),
    )
