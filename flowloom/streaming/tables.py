"""As-of enrichment of a stream with its client state in tables of hash buckets.

The keyed operators of :mod:`flowloom.streaming.asof` hand all rows of one client in a micro-batch to one
task. Where a client may dominate the stream, or where several topics feed one client's states, :func:`asof_sink` runs the batch
operator on each micro-batch instead, which splits hot keys, and keeps the newest state per client in a versioned table between batches. A batch
reads the buckets of its own clients, rewrites only those whose clients changed, and a turn of the others so that expired clients go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from inspect import signature

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.asof import HOT_ROWS, asof_lookup, latest_per_key
from flowloom.sources.versioned import VersionedTable

KEYS = ("client_mac", "namespace_uuid")
BUCKETS, SWEEP = 64, 16


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), F.lit(buckets)).cast("string")


def _buckets_in(df: DataFrame, keys: Sequence[str], buckets: int) -> set[str]:
    """The buckets that the rows fall in; at most as many as there are."""
    if keys[0] not in df.columns:
        return set()
    return {r["b"] for r in df.filter(F.col(keys[0]).isNotNull()).select(bucket_of(keys, buckets).alias("b")).distinct().collect()}


def newest_changes(frames: Sequence[DataFrame], names: Sequence[str], keys: Sequence[str], ts: str, seq: str) -> DataFrame:
    """One row per client with its newest change of each state, as a struct of ``ts``, ``seq`` and the state, in one pass over all frames."""
    place = [*[F.col(k).cast("string").alias(k) for k in keys], F.col(ts).cast("bigint").alias(ts), F.col(seq).cast("bigint").alias(seq)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        d.filter(F.col(keys[0]).isNotNull()).select(*place, *[F.col(f"`{n}`") for n in names if n in d.columns]) for d in frames])
    newest = lambda n: F.max_by(F.struct(ts, seq, f"`{n}`"), F.when(F.col(f"`{n}`").isNotNull(), F.struct(ts, seq))).alias(n)
    return rows.groupBy(*keys).agg(*[newest(n) for n in names])


def _buckets_by_state(newest: DataFrame, names: Sequence[str], keys: Sequence[str], buckets: int) -> dict[str, set[str]]:
    found = newest.groupBy(bucket_of(keys, buckets).alias("_bucket")).agg(*[F.count(f"`{n}`").alias(n) for n in names]).collect()
    return {n: {r["_bucket"] for r in found if r[n]} for n in names}


def asof_sink(
    folder: str,
    split: Callable[..., tuple[DataFrame, list[DataFrame]]],
    finish: Callable[[DataFrame], DataFrame] = lambda found: found,
    keys: Sequence[str] = KEYS,
    ts: str = "timestamp",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
    ttl_seconds: int | None = None,
    buckets: int = BUCKETS,
    sweep: int = SWEEP,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that attaches the latest state to each record.

    ``split`` turns a micro-batch into probe rows and state frames (``shared`` of :func:`asof_lookup`); if it takes a second
    argument, that is the state left by earlier batches for the batch's clients, as frames by state name. ``finish`` shapes the enriched rows. Batch
    ``n`` reads the state version ``n - 1``, overwrites its own ``out`` folder and state version, so a batch that is run again gives the
    same result. With ``ttl_seconds`` a client whose state is older than the newest record by that much is forgotten when its bucket is
    written next: with its changes, or on its turn, every ``sweep`` batches.
    """
    place = [*keys, ts, seq]
    takes_known = len(signature(split).parameters) > 1

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = [batch.persist()]
        try:
            tables = {n: VersionedTable(spark, f"{folder}/state/{n}", "bucket") for n in _names(spark, folder)} if batch_id else {}
            before = {n: max((v for v in t.versions() if v < batch_id), default=None) for n, t in tables.items()}
            here = _buckets_in(batch, keys, buckets) if tables else set()
            known = {n: d.drop("bucket") for n, t in tables.items() if (d := t.read(before[n], here)) is not None}
            probes, frames = split(batch, known) if takes_known else split(batch)
            # the lookup and the new state both read the frames, which may hold lookups of their own: they are made once
            kept += [d.persist() for d in frames]
            found = asof_lookup(probes, {}, keys, ts, seq, shared=[*known.values(), *frames], hot_rows=hot_rows, count_on=[batch])
            finish(found).write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
            latest = batch.agg(F.max(F.col(ts).cast("bigint"))).first()[0] if ttl_seconds is not None and ts in batch.columns else None
            told = list(dict.fromkeys(c for d in frames for c in d.columns if c not in place))
            if told:
                newest = newest_changes(frames, told, keys, ts, seq).persist()
                kept.append(newest)
            touched = _buckets_by_state(newest, told, keys, buckets) if told else {}
            for n in dict.fromkeys([*tables, *told]):
                table = VersionedTable(spark, f"{folder}/state/{n}", "bucket")
                turn = {str(b) for b in range(batch_id % sweep, buckets, sweep)} if ttl_seconds is not None else set()
                changed = touched.get(n, set()) | turn
                old = table.read(before.get(n), changed)
                if n not in touched and old is None:
                    continue
                fresh = [newest.filter(F.col(f"`{n}`").isNotNull()).select(*keys, *[F.col(f"`{n}`.`{c}`").alias(c) for c in (ts, seq, n)])] if n in touched else []
                rows = reduce(DataFrame.unionByName, [*fresh, *([old.select(*place, n)] if old is not None else [])])
                rows = latest_per_key(rows, keys, [ts, seq]).select(*place, n)
                if latest is not None:
                    rows = rows.filter(F.col(ts) > latest - ttl_seconds)
                table.commit(batch_id, rows.withColumn("bucket", bucket_of(keys, buckets)).repartition("bucket"), changed, before.get(n))
                table.vacuum()
        finally:
            for d in kept:
                d.unpersist()
    return write


def _names(spark, folder: str) -> list[str]:
    """State names that earlier batches have written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/state")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []
