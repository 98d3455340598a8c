"""Running streams to a table, with checkpoints in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a session on one machine (tests) may leave it unset."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="flowloom-")


@contextmanager
def state_provider(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """Queries started inside keep their state with ``provider`` (None: the session's own), which a started query holds on to."""
    if provider is None:
        yield
        return
    before = spark.conf.get(PROVIDER_SETTING, None)
    spark.conf.set(PROVIDER_SETTING, provider)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_SETTING)
        else:
            spark.conf.set(PROVIDER_SETTING, before)


def run_available(stream: DataFrame, folder: str | None = None, name: str = "stream", output_mode: str = "append",
                  provider: str | None = None) -> DataFrame:
    """Process everything the source holds now and return the result table.

    Results and checkpoint go under ``folder`` (default: a new one in :func:`shared_folder`); calling
    again with the same folder resumes where the last run stopped. ``provider`` is the state store's where the stream needs
    a certain one: keyed state with timers and lists (``stream_asof``, ``stream_nmsp``) is kept by :data:`ROCKSDB` only.
    """
    spark = stream.sparkSession
    folder = folder or f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with state_provider(spark, provider):
        query = (
            stream.writeStream.format("parquet").outputMode(output_mode)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start(f"{folder}/table")
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")
