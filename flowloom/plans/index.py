"""The index job: enriched topics to minute rollups, one table per target, divided by datasource."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.fields import ROUTES
from flowloom.operators.counters import datasource_name
from flowloom.operators.rollup import GRANULARITY, SPECS, RollupSpec, merge_rollups, rollup
from flowloom.sources.topics import with_extras, write_topic
from flowloom.sources.versioned import VersionedTable

_NUMERIC = {"lsum": "bigint", "dsum": "double", "min": "double", "max": "double", "histogram": "double"}


def index_schema(target: str) -> str:
    """DDL schema of the messages of an indexed topic: its dimensions as text, its metrics as numbers."""
    spec = SPECS[target]
    kinds = dict.fromkeys(spec.dims or ("monitor", "sensor_name", "sensor_uuid", "namespace_uuid", "unit", "type"), "string")
    kinds = {"timestamp": "bigint", "namespace_uuid": "string", **kinds}
    for kind, source in spec.aggs.values():
        if source and source not in kinds:
            kinds[source] = _NUMERIC.get(kind, "string")
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())


def _inputs(spec: RollupSpec) -> list[str]:
    return [*(spec.dims or ()), *[source for _, source in spec.aggs.values() if source]]


def index(topics: dict[str, DataFrame], mode: str = "approx", now: Column | None = None, use_namespace: bool = True) -> dict[str, DataFrame]:
    """Rollups by target of the enriched topics given by name; streams get their target's late limit.

    Every output has ``datasource``, all dimensions of its target and all its metrics, whatever the messages carried; fields that
    ingest left in ``extras`` are found there. Topics with one target are one rollup. An unknown topic raises here.
    """
    known = {topic: (target, base) for topic, target, base in ROUTES}
    parts: dict[str, list[DataFrame]] = {}
    for topic, df in topics.items():
        if topic not in known:
            raise KeyError(f"topic {topic!r} is not indexed")
        target, base = known[topic]
        df = with_extras(df, _inputs(SPECS[target]))
        namespace = F.col("namespace_uuid") if "namespace_uuid" in df.columns else F.lit(None)
        parts.setdefault(target, []).append(df.withColumn("datasource", datasource_name(base, namespace, use_namespace)))
    out = {}
    for target, frames in parts.items():
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        out[target] = rollup(rows, SPECS[target], mode, now, ("datasource",), watermark=rows.isStreaming, complete=True)
    return out


PART, PART_SECONDS = "part", 3600


def index_sink(folder: str, target: str, topics_of: Callable[[DataFrame], dict[str, DataFrame]], now: Column | None = None, part_seconds: int = PART_SECONDS, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps one row per minute and dimensions of a target, whatever batches its records came in.

    A batch is rolled up with sketches and merged with the rows of the times it touches, in parts of ``part_seconds``; only those parts are
    written, as a new version of the table, so late minutes and repeated batches never leave doubled rows. Read it with :func:`read_index`.
    """
    spec = SPECS[target]
    own_part = F.floor(F.col("timestamp") / part_seconds).cast("string")

    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, f"{folder}/{target}", PART)
        base = max((v for v in table.versions() if v < batch_id), default=None)
        parts = index(topics_of(batch), "sketch", now)[target]
        parts = parts.withColumn(PART, own_part).persist()
        try:
            touched = [r[PART] for r in parts.select(PART).distinct().collect()]  # hours of one micro-batch
            old = table.read(base, touched)
            merged = parts.drop(PART)  # one row per minute and dimensions already
            if old is not None:
                rows = merged.unionByName(old.drop(PART), allowMissingColumns=True)
                dims = ["datasource", *[c for c in rows.columns if c not in _made(spec) and c not in ("datasource", "timestamp")]]
                merged = merge_rollups(rows, spec, dims, GRANULARITY, keep_sketches=True)
            table.commit(batch_id, merged.withColumn(PART, own_part).repartition(PART, "datasource"), touched, base)
            table.vacuum(keep)
        finally:
            parts.unpersist()
    return write


def read_index(spark: SparkSession, folder: str, target: str) -> DataFrame | None:
    """The newest version of a target's minutes, with sketches as numbers (histogram sketches stay)."""
    table = VersionedTable(spark, f"{folder}/{target}", PART)
    rows = table.read(max(table.versions(), default=None))
    if rows is None:
        return None
    sketches = {n: F.hll_sketch_estimate(n) for n, (kind, _) in SPECS[target].aggs.items() if kind == "distinct"}
    return rows.drop(PART).withColumns(sketches)


def _made(spec: RollupSpec) -> set[str]:
    return {*spec.aggs, *[f"{n}_{side}" for n, (kind, _) in spec.aggs.items() if kind == "histogram" for side in ("below", "above", "sketch")]}


def write_index(rollups: dict[str, DataFrame], location: str, **options) -> list:
    """Write each target's rollups under ``location``, one folder per datasource; for streams, the started queries."""
    def at(target: str) -> dict:
        return {"checkpoint": f"{location}/_checkpoints/{target}"} if rollups[target].isStreaming else {}
    return [write_topic(df, f"{location}/{target}", partition_by=("datasource",), **at(target), **options) for target, df in rollups.items()]
