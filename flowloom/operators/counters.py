"""Message counters per window, the previous window's count, and the capacity report built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_SECONDS = 60
DAY = 86_400

# Topic families the per-stream counter and the capacity report know.
FAMILIES = ["rb_flow", "rb_monitor", "rb_event", "rb_state", "rb_social"]

# Capacity settings.
EVENTS_PER_TASK, UP, DOWN, TOPIC_PARTITIONS = 5000, 0.80, 0.20, 4
CAPACITY_FAMILIES = {"rb_flow": TOPIC_PARTITIONS, "rb_event": TOPIC_PARTITIONS}


def datasource_name(base: Column | str, namespace: Column, use_namespace: bool = True) -> Column:
    """``base`` or ``base_<namespace>``."""
    base = F.lit(base) if isinstance(base, str) else base
    if not use_namespace:
        return base
    return F.when(namespace.isNotNull(), F.concat_ws("_", base, namespace.cast("string"))).otherwise(base)


def _window_start(ts: Column, seconds: int) -> Column:
    return ts - F.pmod(ts, F.lit(seconds))


def datasource_counts(df: DataFrame, seconds: int = WINDOW_SECONDS, ts: str = "timestamp") -> DataFrame:
    """``(datasource, window_start, events)``: rows per datasource and tumbling window."""
    return df.groupBy(
        "datasource", _window_start(F.col(ts), seconds).alias("window_start")
    ).agg(F.count(F.lit(1)).alias("events"))


def monitor_rows(counts: DataFrame, seconds: int = WINDOW_SECONDS, container: str = "0", task: str = "0",
                 prefix: str = "task") -> DataFrame:
    """Monitor rows of :func:`datasource_counts`, stamped with the end of their window and named after ``prefix``.

    The namespace is the last ``_`` part of a datasource name with three or more parts. Windows that counted nothing give no row.
    """
    parts = F.split("datasource", "_")
    spaced = (F.size(parts) >= 3) & (F.col("datasource") != "rb_loc_post")
    return counts.filter(F.col("datasource").isNotNull() & (F.col("events") > 0)).select(
        (F.col("window_start") + seconds).alias("timestamp"),
        F.lit("enrichmentstreamtask").alias("type"),
        F.lit("enrichmentstreamtask_messages").alias("monitor"),
        F.concat(F.lit(f"{prefix}-{container}-{task}-"), F.col("datasource")).alias("sensor_name"),
        F.col("events").alias("value"),
        F.when(spaced, F.element_at(parts, -1)).alias("namespace_uuid"),
    )


def window_counts(df: DataFrame, seconds: int = WINDOW_SECONDS, ts: str = "timestamp", **names: str) -> DataFrame:
    """Monitor rows of the message counters of ``df``; ``names`` as in :func:`monitor_rows`."""
    return monitor_rows(datasource_counts(df, seconds, ts), seconds, **names)


def stream_counts(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Rows per topic family and namespace; unknown families count under an empty name."""
    family = F.coalesce(*[F.when(F.contains(F.col(topic), F.lit(f)), F.lit(f)) for f in FAMILIES], F.lit(""))
    name = F.when(F.col("namespace_uuid").isNotNull(),
                  F.concat(family, F.lit("_"), F.col("namespace_uuid").cast("string"))).otherwise(family)
    return df.groupBy(name.alias("stream")).agg(F.count(F.lit(1)).alias("events"))


def with_prev_window_count(df: DataFrame, counts: DataFrame | None = None, seconds: int = WINDOW_SECONDS,
                           ts: str = "timestamp", first: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """Add ``flows_count``: rows of the same datasource in the window before this one.

    Once a datasource has appeared its counter stays known and an idle window counts zero; before its
    first completed window the value is NULL. ``counts`` may come from a written
    :func:`datasource_counts` table; it is far smaller than the data and broadcast when its size allows. Where it holds only
    the windows from ``since`` on, ``first`` (datasource, window_start) tells when each datasource appeared, and rows whose window
    before is older than ``since`` get NULL.
    """
    counts = datasource_counts(df, seconds, ts) if counts is None else counts
    return join_prev_window(df, prev_window_table(counts, seconds, first, since), seconds, ts)


def prev_window_table(counts: DataFrame, seconds: int = WINDOW_SECONDS, first: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """One row per datasource and window of ``counts`` with its ``flows_count``, for :func:`join_prev_window`.

    Kept (persisted and counted) its size is known, and Spark broadcasts it if that allows, so wide records stay where they are.
    """
    first = counts.groupBy("datasource").agg(F.min("window_start").alias("window_start")) if first is None else first
    first = first.select("datasource", F.col("window_start").alias("_first"))
    prev = counts.select(
        F.col("datasource").alias("_ds"), (F.col("window_start") + seconds).alias("_next"), F.col("events").alias("_n"))
    # one row per datasource and window that occurs, so the wide rows are joined once
    table = counts.join(first, "datasource", "left").join(
        prev, (F.col("datasource") == F.col("_ds")) & (F.col("window_start") == F.col("_next")), "left")
    known = F.col("window_start") > F.col("_first")
    if since is not None:
        known = known & (F.col("window_start") - seconds >= since)
    return table.select(
        F.col("datasource").alias("_ds"), F.col("window_start").alias("_ws"),
        F.when(known, F.coalesce(F.col("_n"), F.lit(0))).alias("flows_count"))


def join_prev_window(df: DataFrame, table: DataFrame, seconds: int = WINDOW_SECONDS, ts: str = "timestamp") -> DataFrame:
    """``df`` with the ``flows_count`` of its datasource and window from :func:`prev_window_table`."""
    rows = df.drop("flows_count").withColumn("_start", _window_start(F.col(ts), seconds))
    hit = (F.col("datasource") == F.col("_ds")) & (F.col("_start") == F.col("_ws"))
    return rows.join(table, hit, "left").drop("_start", "_ds", "_ws")


def capacity_report(counts: DataFrame, limits: DataFrame | None = None, seconds: int = WINDOW_SECONDS,
                    per_task: int = EVENTS_PER_TASK, up: float = UP, down: float = DOWN,
                    partitions: dict[str, int] | None = None) -> DataFrame:
    """Recommended index partitions per datasource after its last window.

    ``counts`` is :func:`datasource_counts`; ``limits`` is ``(datasource, index_partitions,
    index_replicas)``, NULL or 0 meaning 1. Load is ``(events div window) * topic partitions`` of the
    datasource's family. The first window sets the count within ``[1, limit]``; later windows change it
    only above ``up`` or below ``down`` of the current capacity. Datasources of no configured family are left out.

    A day of windows is a function from the count before it to the count after it, a short array over ``0..limit``; days
    compose in order. No row holds more than one day's windows, or one array per day.
    """
    partitions = CAPACITY_FAMILIES if partitions is None else partitions
    factor = F.coalesce(*[F.when(F.contains("datasource", F.lit(f)), F.lit(n)) for f, n in partitions.items()])
    load = F.expr(f"events div {seconds}") * F.col("_factor")
    rows = counts.withColumn("_factor", factor).filter(F.col("_factor").isNotNull())
    by_day = rows.groupBy("datasource", F.floor(F.col("window_start") / DAY).alias("_day")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("window_start", load.alias("load")))), lambda x: x.load
        ).alias("_loads"))
    one = lambda c: F.when(c > 0, c).otherwise(F.lit(1)).cast("int")
    if limits is None:
        by_day = by_day.withColumns({"_limit": F.lit(1), "replicas": F.lit(1)})
    else:
        by_day = by_day.join(limits, "datasource", "left").withColumns({
            "_limit": one(F.col("index_partitions")), "replicas": one(F.col("index_replicas"))})

    def step(current: Column, load: Column) -> Column:
        wanted = F.ceil(load.cast("double") / per_task).cast("int")
        at_least_one = F.greatest(wanted, F.lit(1))
        clamped = F.least(at_least_one, F.col("_limit"))
        capacity = current * per_task
        return (
            F.when(current == 0, clamped)
            .when(capacity * up <= load, clamped)
            .when(capacity * down >= load, F.least(at_least_one, current))
            .otherwise(current)
        )
    after = F.transform(F.sequence(F.lit(0), F.col("_limit")), lambda before: F.aggregate("_loads", before, step))
    days = by_day.select("datasource", "replicas", F.size("_loads").alias("_n"), F.struct("_day", after.alias("after")).alias("_step"))
    series = days.groupBy("datasource", "replicas").agg(
        F.array_sort(F.collect_list("_step")).alias("_steps"), F.sum("_n").cast("int").alias("windows"))
    final = F.aggregate("_steps", F.lit(0), lambda current, day: F.element_at(day.after, current + 1))
    return series.select("datasource", final.alias("partitions"), "replicas", "windows")
