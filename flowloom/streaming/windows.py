"""Windowed streaming: rollups with late limits, message counters, previous-window counts, capacity."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.operators import counters
from flowloom.operators.rollup import RollupSpec, event_seconds, rollup
from flowloom.streaming.wiring import run_available


def stream_rollup(df: DataFrame, spec: RollupSpec, mode: str = "sketch", extra_dims: tuple[str, ...] = ()) -> DataFrame:
    """Append-mode rollup; records later than the spec's limit behind the newest event time are left out."""
    return rollup(df, spec, mode=mode, extra_dims=extra_dims, watermark=True)


def stream_window_counts(df: DataFrame, late: str = "0 seconds", seconds: int = counters.WINDOW_SECONDS) -> DataFrame:
    """``(datasource, window_start, events)`` as each window closes."""
    timed = df.withColumn("_at", F.timestamp_seconds("timestamp")).withWatermark("_at", late)
    counted = timed.groupBy(F.window("_at", f"{seconds} seconds").alias("w"), "datasource").agg(
        F.count(F.lit(1)).alias("events"))
    return counted.select("datasource", F.unix_timestamp(F.col("w.start")).alias("window_start"), "events")


def _late_seconds(late: str) -> int:
    number, unit = late.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def rollup_to_end(stream: DataFrame, rows: DataFrame, spec: RollupSpec, mode: str = "sketch", extra_dims: tuple[str, ...] = (),
                  folder: str | None = None, name: str = "rollup") -> DataFrame:
    """:func:`stream_rollup` of a source that has an end: what the stream wrote, and the windows it left open.

    ``rows`` is the source as a batch. The last watermark is its newest time less the late limit; windows that end behind it were
    closed by the stream, the others are rolled up in one batch pass over their rows only.
    """
    closed = run_available(stream_rollup(stream, spec, mode, extra_dims), folder, name)
    at = event_seconds(rows, spec)
    newest = rows.agg(F.max(at)).first()[0]
    if newest is None:
        return closed
    still = rows.filter(at - F.pmod(at, F.lit(60)) + 60 > newest - _late_seconds(spec.late))
    return closed.unionByName(rollup(still, spec, mode, extra_dims=extra_dims).select(*closed.columns))


def window_counts_to_end(stream: DataFrame, rows: DataFrame, late: str = "0 seconds", seconds: int = counters.WINDOW_SECONDS,
                         folder: str | None = None, name: str = "counts") -> DataFrame:
    """:func:`stream_window_counts` of a source that has an end, with the windows left open; ``rows`` is the source as a batch."""
    closed = run_available(stream_window_counts(stream, late, seconds), folder, name)
    newest = rows.agg(F.max("timestamp")).first()[0]
    if newest is None:
        return closed
    counts = counters.datasource_counts(rows.filter(F.col("timestamp") + seconds > newest - _late_seconds(late)), seconds)
    return closed.unionByName(counts.filter(F.col("window_start") + seconds > newest - _late_seconds(late)).select(*closed.columns))


def stream_capacity(counts: DataFrame, limits: DataFrame | None = None, seconds: int = counters.WINDOW_SECONDS,
                    per_task: int = counters.EVENTS_PER_TASK, up: float = counters.UP, down: float = counters.DOWN,
                    partitions: dict[str, int] | None = None) -> DataFrame:
    """Recommended partitions per datasource and window, kept as keyed state of one number.

    ``limits`` is the static table of :func:`flowloom.operators.counters.capacity_report`. A group is one row per window of a
    datasource, however many messages a window counted.
    """
    partitions = counters.CAPACITY_FAMILIES if partitions is None else partitions
    one = lambda c: F.when(c > 0, c).otherwise(F.lit(1)).cast("int")
    none = F.lit(None).cast("int")
    if limits is not None:
        counts = counts.join(limits, "datasource", "left")
    limit, replicas = (none, none) if limits is None else (F.col("index_partitions"), F.col("index_replicas"))

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values("window_start")
        current = state.get[0] if state.exists else 0
        factor = next(n for f, n in partitions.items() if f in key[0])
        made = []
        for events, limit in zip(rows["events"], rows["limit"]):
            load = int(events) // seconds * factor
            wanted = max(math.ceil(load / per_task), 1)
            if current == 0 or current * per_task * up <= load:
                current = min(wanted, int(limit))
            elif current * per_task * down >= load:
                current = min(wanted, current)
            made.append(current)
        state.update((current,))
        yield rows[["datasource", "window_start", "events", "replicas"]].assign(partitions=made)

    known = [F.contains("datasource", F.lit(f)) for f in partitions]
    rows = counts.filter(F.coalesce(*[F.when(k, F.lit(True)) for k in known], F.lit(False))).select(
        "datasource", "window_start", "events", one(limit).alias("limit"), one(replicas).alias("replicas"))
    return rows.groupBy("datasource").applyInPandasWithState(
        fold, "datasource string, window_start bigint, events bigint, replicas int, partitions int", "current int", "append",
        GroupStateTimeout.NoTimeout)


def batch_sink(transform: Callable[[DataFrame], DataFrame], path: str, partition_by: tuple[str, ...] = ()):
    """``foreachBatch`` function: run a batch operator on each micro-batch and write it under its batch id.

    Rewriting a batch after a failure replaces its own folder, so each record appears once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = transform(batch).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")
    return write


def prev_window_sink(folder: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, seconds: int = counters.WINDOW_SECONDS,
                     ts: str = "timestamp", kept_windows: int | None = 15) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds ``flows_count`` with windows counted over the micro-batches so far.

    Batch ``n`` reads the counters that batch ``n - 1`` left (when each datasource appeared, and its last ``kept_windows``
    windows; None keeps all) and overwrites its own, and its rows in ``folder/out``, so a batch that runs again replaces its own. Rows in time order get
    what the batch operator gives; a record that comes after its successor window was written is counted from then on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = lambda table, i: f"{folder}/{table}/batch_id={i}"
        rows = prepare(batch).persist()
        try:
            known = counters.datasource_counts(rows, seconds, ts)
            first = known.groupBy("datasource").agg(F.min("window_start").alias("window_start"))
            since = None
            if batch_id:
                left = spark.read.parquet(at("counts", batch_id - 1))
                if kept_windows is not None:
                    since = left.agg(F.max("window_start") - kept_windows * seconds).first()[0]
                known = known.unionByName(left).groupBy("datasource", "window_start").agg(F.sum("events").alias("events"))
                first = first.unionByName(spark.read.parquet(at("first", batch_id - 1))).groupBy("datasource").agg(F.min("window_start").alias("window_start"))
            known = known.persist()
            counters.with_prev_window_count(rows, known, seconds, ts, first, since).write.mode("overwrite").parquet(at("out", batch_id))
            if kept_windows is not None:
                newest = known.agg(F.max("window_start")).first()[0]
                kept = known.filter(F.col("window_start") >= newest - kept_windows * seconds) if newest is not None else known
            kept_counts = kept if kept_windows is not None else known
            kept_counts.coalesce(1).write.mode("overwrite").parquet(at("counts", batch_id))
            first.coalesce(1).write.mode("overwrite").parquet(at("first", batch_id))
            known.unpersist()
        finally:
            rows.unpersist()
    return write
