"""A topic's plan on a stream: records, window counts and monitor rows of each micro-batch, committed together.

A micro-batch writes its records, the monitor rows of the windows it closed and the counters it leaves under its batch id, then
a marker. Readers see marked batches only, and a batch that runs again replaces all of its own, so records, counts and
monitor rows never disagree. The counters left behind are one row per datasource plus those of the last windows, whatever the stream's length.

Clock: a window closes when a record of a later window has come. Records that come after their window was closed are counted by the next
monitor row of that window, so every record is in exactly one; their ``flows_count`` is NULL once the window before is no longer kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import counters
from flowloom.plans import topics

#: windows before the newest that stay known for flows_count
KEPT_WINDOWS = 2


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def topic_sink(folder: str, topic: str, context: topics.Context | None = None, seconds: int = counters.WINDOW_SECONDS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that runs the topic's plan on each micro-batch.

    Under ``folder``: ``records/<step>``, ``monitor``, ``windows`` and ``first`` (the counters), ``done``; see :func:`read_outputs`.
    """
    def at(table: str, batch_id: int) -> str:
        return f"{folder}/{table}/batch_id={batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        frames = topics.run_steps(topics.with_clock(batch, context) if topic in topics.COUNTED else batch, topic, context)
        counted = topic in topics.COUNTED
        frames = [(topics.name_and_clock(f, topic) if counted else f).persist() for f in frames]
        try:
            if not counted:
                for i, f in enumerate(frames):
                    topics.published(f).write.mode("overwrite").parquet(at(f"records/{i}", batch_id))
            else:
                fresh = topics.count_frames(frames, seconds)
                first = fresh.groupBy("datasource").agg(F.min("window_start").alias("window_start"))
                fresh = fresh.withColumn("open", F.lit(True))
                if batch_id:
                    fresh = fresh.unionByName(spark.read.parquet(at("windows", batch_id - 1)))
                    first = first.unionByName(spark.read.parquet(at("first", batch_id - 1))).groupBy("datasource").agg(F.min("window_start").alias("window_start"))
                fresh = fresh.persist()
                before = spark.read.parquet(at("windows", batch_id - 1)).agg(F.max("window_start")).first()[0] if batch_id else None
                newest = fresh.agg(F.max("window_start")).first()[0]
                since = None if before is None else before - KEPT_WINDOWS * seconds
                known = fresh.groupBy("datasource", "window_start").agg(F.sum("events").alias("events"))
                table = counters.prev_window_table(known, seconds, first, since).persist()
                table.count()
                for i, f in enumerate(frames):
                    rows = counters.join_prev_window(topics.published(f), table, seconds, topics.CLOCK)
                    rows.drop("datasource", topics.CLOCK).write.mode("overwrite").parquet(at(f"records/{i}", batch_id))
                due = fresh.filter("open").groupBy("datasource", "window_start").agg(F.sum("events").alias("events"))
                closed = due.filter(F.col("window_start") < newest) if newest is not None else due.limit(0)
                counters.monitor_rows(closed, seconds).write.mode("overwrite").parquet(at("monitor", batch_id))
                kept = known.filter(F.col("window_start") >= newest - KEPT_WINDOWS * seconds) if newest is not None else known
                kept.withColumn("open", F.col("window_start") >= newest if newest is not None else F.lit(True)).coalesce(1).write.mode("overwrite").parquet(at("windows", batch_id))
                first.write.mode("overwrite").parquet(at("first", batch_id))
                table.unpersist()
                fresh.unpersist()
            spark.range(1).write.mode("overwrite").parquet(at("done", batch_id))
            for table in ("windows", "first") if batch_id > 1 else ():
                _remove(spark, at(table, batch_id - 2))
        finally:
            for f in frames:
                f.unpersist()
    return write


def run_stream(stream: DataFrame, folder: str, topic: str, context: topics.Context | None = None, seconds: int = counters.WINDOW_SECONDS) -> None:
    """Process everything the source holds now; calling again with the same folder goes on where the last run stopped."""
    query = stream.writeStream.foreachBatch(topic_sink(folder, topic, context, seconds)).option("checkpointLocation", f"{folder}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()


def read_outputs(spark: SparkSession, folder: str, closing: bool = False, seconds: int = counters.WINDOW_SECONDS, steps: int = 1) -> topics.Outputs:
    """Records and monitor rows of the committed micro-batches.

    With ``closing`` the source has ended: the windows still open count as closed, and their monitor rows are added.
    """
    done = spark.read.parquet(f"{folder}/done").select("batch_id").distinct()
    committed = lambda table: spark.read.option("mergeSchema", "true").parquet(f"{folder}/{table}").join(F.broadcast(done), "batch_id", "left_semi").drop("batch_id")
    out = topics.Outputs(committed(f"records/{i}") for i in range(steps))
    last = done.agg(F.max("batch_id")).first()[0]
    tables = [committed("monitor")]
    if closing:
        left = spark.read.parquet(f"{folder}/windows/batch_id={last}").filter("open")
        tables.append(counters.monitor_rows(left.groupBy("datasource", "window_start").agg(F.sum("events").alias("events")), seconds))
    out.monitor = reduce(DataFrame.unionByName, tables)
    return out
