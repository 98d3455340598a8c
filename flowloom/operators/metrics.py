"""Job and service metrics flattened to monitor rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import iso_seconds


def flatten_job_metrics(df: DataFrame, class_filter: str) -> DataFrame:
    """``asMap.metrics.{class}.{metric}`` to one row per metric of the classes containing ``class_filter``."""
    classes = df.select(
        *[c for c in ("event_id",) if c in df.columns],
        F.col("asMap.header").alias("_h"), F.explode("asMap.metrics").alias("_class", "_metrics"),
    ).withColumn("_class", F.lower("_class")).filter(F.contains("_class", F.lit(class_filter.lower())))
    rows = classes.select("*", F.explode("_metrics").alias("_metric", "value"))
    short = F.try_element_at(F.split("_class", r"\."), F.lit(-1))
    partition = F.get(F.split(F.col("_h.source"), " "), F.lit(1))
    return rows.select(
        *[c for c in ("event_id",) if c in df.columns],
        F.floor(F.col("_h.time") / 1000).alias("timestamp"),
        F.concat(F.col("_h.`container-name`"), F.lit("-"), partition).alias("sensor_name"),
        short.alias("type"),
        F.concat(short, F.lit("_"), F.col("_metric")).alias("monitor"),
        "value",
    )


# Service name, metric field and the column it fills.
SERVICE_FIELDS = {
    "historical": {"user1": "data_source", "user2": "tier"},
    "realtime": {"user1": "data_source", "user2": "data_source"},
    "overlord": {"user2": "data_source", "user3": "task_status", "user4": "task_type", "user5": "segment_interval"},
    "indexer": {"user2": "data_source", "user3": "task_status", "user4": "task_type", "user5": "segment_interval"},
}
# The coordinator's segment metrics name a data source, its others a server.
COORDINATOR_SEGMENTS = ["coordinator/segment/size", "coordinator/segment/count"]
# Metric field and column of query metrics, whatever the service.
QUERY_FIELDS = {
    "user2": "data_source", "user3": "query_context_dump", "user4": "query_type", "user5": "query_interval",
    "user8": "query_id", "user9": "query_duration",
}
METRIC_COLUMNS = [
    "data_source", "tier", "historical_server", "task_status", "task_type", "segment_interval",
    "query_context_dump", "query_type", "query_interval", "query_id", "query_duration",
]


def flatten_service_metrics(df: DataFrame, items: str = "metrics") -> DataFrame:
    """List-shaped service metrics, one row per list element, fields renamed by service and metric."""
    have = {f.name for f in df.schema[items].dataType.elementType.fields}
    m = lambda name: F.col(f"_m.{name}") if name in have else F.lit(None).cast("string")
    rows = df.select(*[c for c in ("event_id",) if c in df.columns], F.explode(items).alias("_m"))
    service, metric = m("service"), m("metric")
    choices: dict[str, list[Column]] = {c: [] for c in METRIC_COLUMNS}
    for name, target in QUERY_FIELDS.items():
        choices[target].append(F.when(F.contains(metric, F.lit("query")), m(name)))
    for name, fields in SERVICE_FIELDS.items():
        for field, target in reversed(fields.items()):
            choices[target].append(F.when(service == name, m(field)))
    segments = metric.isin(COORDINATOR_SEGMENTS)
    coordinator = service == "coordinator"
    choices["data_source"].append(F.when(coordinator & segments, m("user1")))
    choices["historical_server"].append(F.when(coordinator & ~F.coalesce(segments, F.lit(False)), m("user1")))
    return rows.select(
        *[c for c in ("event_id",) if c in df.columns],
        iso_seconds(m("timestamp")).alias("timestamp"),
        m("host").alias("sensor_name"),
        F.concat(service, F.lit("/"), metric).alias("monitor"),
        m("value").cast("double").alias("value"),
        *[F.coalesce(*choices[c]).alias(c) for c in METRIC_COLUMNS],
    )
