"""Keyed state for streams: the latest client state attached to each later record.

The same rows come out as from :func:`flowloom.operators.asof.asof_lookup` as long as records of a client
arrive in time order across micro-batches; inside a micro-batch their order does not matter.

A client's rows of a micro-batch are read in Arrow chunks and never put together: its state changes (small) are gathered, its records
wait in a list state, off the heap, if they fill more than one chunk, and leave chunk by chunk. What a client leaves for later batches is one
row per state name, which a timer removes when the stream's newest record is a time to live ahead of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _tag(df: DataFrame, keys: Sequence[str], ts: str, seq: str, kind: str, rank: int, payload) -> DataFrame:
    return df.filter(F.col(keys[0]).isNotNull()).select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.col(ts).cast("bigint").alias("asof_ts"), F.lit(rank).alias("asof_rank"), F.col(seq).cast("bigint").alias("asof_seq"),
        F.lit(kind).alias("asof_kind"), payload.alias("asof_payload"),
    )


class _Follower(StatefulProcessor):
    """Attaches a client's latest states to its records; see :func:`stream_asof`."""

    def __init__(self, names: list[str], columns: list[str], ttl_seconds: int | None, max_age: int | None):
        self.names, self.columns, self.ttl, self.max_age = names, columns, ttl_seconds, max_age

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"s{i} string, t{i} bigint" for i in range(len(self.names)))
        self.handle = handle
        self.known = handle.getValueState("known", fields)
        self.waiting = handle.getListState("waiting", "ts bigint, seq bigint, payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        changes: list[pd.DataFrame] = []
        held, spilled = None, False
        for chunk in rows:
            is_probe = (chunk["asof_kind"] == "").to_numpy()
            if not is_probe.all():
                changes.append(chunk.loc[~is_probe, ["asof_kind", "asof_ts", "asof_seq", "asof_payload"]])
            probes = chunk.loc[is_probe, ["asof_ts", "asof_seq", "asof_payload"]]
            if not len(probes):
                continue
            if held is None and not spilled:
                held = probes
            else:
                for part in (held, probes):
                    if part is not None:
                        self.waiting.appendList(list(part.itertuples(index=False, name=None)))
                held, spilled = None, True
        before = list(self.known.get()) if self.known.exists() else [None] * (2 * len(self.names))
        made = pd.concat(changes, ignore_index=True) if changes else None  # one row per state change of the batch
        timelines, after = [], list(before)
        for i, name in enumerate(self.names):
            own = made[made["asof_kind"] == name].sort_values(["asof_ts", "asof_seq"]) if made is not None else None
            times = own["asof_ts"].to_numpy(np.int64) if own is not None else np.zeros(0, np.int64)
            values = own["asof_payload"].tolist() if own is not None else []
            timelines.append((times, [before[2 * i], *values], [before[2 * i + 1], *times.tolist()]))
            if len(times):
                after[2 * i:2 * i + 2] = [values[-1], int(times[-1])]
        if made is not None:
            self.known.update(tuple(after))
            if self.ttl is not None and (newest := self._newest(after)) != (last := self._newest(before)):
                if last is not None:
                    self.handle.deleteTimer(1000 * last)
                self.handle.registerTimer(1000 * newest)
        if held is not None:
            yield self._attached(key, held, timelines)
        if spilled:
            size, part = 10_000, []
            for row in self.waiting.get():
                part.append(tuple(row))
                if len(part) == size:
                    yield self._attached(key, pd.DataFrame(part, columns=["asof_ts", "asof_seq", "asof_payload"]), timelines)
                    part = []
            if part:
                yield self._attached(key, pd.DataFrame(part, columns=["asof_ts", "asof_seq", "asof_payload"]), timelines)
            self.waiting.clear()
        if held is None and not spilled:
            yield pd.DataFrame({c: pd.Series(dtype="int64" if c in ("asof_ts", "asof_seq") else object) for c in self.columns})

    def _attached(self, key: tuple, probes: pd.DataFrame, timelines: list) -> pd.DataFrame:
        out = {c: [v] * len(probes) for c, v in zip(self.columns, key, strict=False)}
        out |= {c: probes[c].to_numpy() for c in ("asof_ts", "asof_seq", "asof_payload")}
        at = probes["asof_ts"].to_numpy(np.int64)
        for i, (times, values, stamps) in enumerate(timelines):
            places = np.searchsorted(times, at, side="right")  # a state of the same second is visible
            found = [values[p] for p in places]
            if self.max_age is not None:
                found = [v if stamps[p] is not None and t - stamps[p] < self.max_age else None for v, p, t in zip(found, places, at.tolist(), strict=True)]
            out[f"asof_s{i}"] = found
        return pd.DataFrame(out)[self.columns]

    def _newest(self, known) -> int | None:
        return max((t for t in known[1::2] if t is not None), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.known.exists() and 1000 * self._newest(self.known.get()) <= expiredTimerInfo.getExpiryTimeInMs():
            self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_asof(probes: DataFrame, states: dict[str, DataFrame], keys: Sequence[str] = ("client_mac", "namespace_uuid"),
                ts: str = "timestamp", seq: str = "event_id", ttl_seconds: int | None = None, max_age: int | None = None) -> DataFrame:
    """Streaming form of ``asof_lookup``: payloads travel as JSON text and come back typed.

    State is one small JSON text per state name and client. A client's state goes once the stream's newest record is ``ttl_seconds`` (event
    time) ahead of it, which bounds the store by the clients that left state in that time; without it nothing goes. ``max_age`` hides states
    older than that from a record. No record is dropped for being late: only one that comes more than the time to live late may miss
    a state that was in force. Probe rows without a first key neither leave nor see state: they pass by the state operator.
    The state needs Spark's RocksDB store: start the stream in a session that names it, or by ``run_available(..., provider=ROCKSDB)``.
    """
    keys, names = list(keys), list(states)
    skip = {*keys, ts, seq}
    fields = {n: [c for c in d.columns if c not in {*skip, "deleted"}] for n, d in states.items()}
    probe_fields = [c for c in probes.columns if c not in skip]
    kinds = {n: d.select(F.struct(*fields[n]).alias("p")).schema["p"].dataType for n, d in states.items()}
    probe_kind = probes.select(F.struct(*probe_fields).alias("p")).schema["p"].dataType

    def state_payload(n: str, d: DataFrame):
        text = F.to_json(F.struct(*fields[n]))
        return F.when(~F.coalesce(F.col("deleted"), F.lit(False)), text).otherwise("") if "deleted" in d.columns else text

    parts = [_tag(d, keys, ts, seq, n, i, state_payload(n, d)) for i, (n, d) in enumerate(states.items())]
    parts.append(_tag(probes, keys, ts, seq, "", len(names), F.to_json(F.struct(*probe_fields))))
    union = reduce(DataFrame.unionByName, parts).withColumn("asof_nulls", F.concat(*[
        F.col(k).isNull().cast("int").cast("string") for k in keys]))
    groups = union.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys})
    if ttl_seconds is not None:
        # the watermark moves timers only: without its column the operator leaves no late row out
        groups = groups.withColumn("asof_at", F.timestamp_seconds("asof_ts")).withWatermark("asof_at", f"{ttl_seconds} seconds").drop("asof_at")

    columns = [*keys, "asof_nulls", "asof_ts", "asof_seq", "asof_payload", *[f"asof_s{i}" for i in range(len(names))]]
    output = ", ".join([
        *[f"`{k}` string" for k in keys], "asof_nulls string, asof_ts bigint, asof_seq bigint, asof_payload string",
        *[f"asof_s{i} string" for i in range(len(names))]])
    flowing = groups.groupBy(*keys, "asof_nulls").transformWithStateInPandas(
        _Follower(names, columns, ttl_seconds, max_age), output, "append", "None" if ttl_seconds is None else "EventTime")
    back = lambda i, k: F.when(F.substring("asof_nulls", i + 1, 1) == "0", F.col(k)).alias(k)
    typed = flowing.select(
        *[back(i, k) for i, k in enumerate(keys)], F.col("asof_ts").alias(ts), F.col("asof_seq").alias(seq),
        F.from_json("asof_payload", probe_kind).alias("_p"),
        *[F.from_json(F.when(F.col(f"asof_s{i}") != "", F.col(f"asof_s{i}")), kinds[n]).alias(n) for i, n in enumerate(names)],
    )
    found = typed.select(*keys, ts, seq, "_p.*", *names)
    keyless = probes.filter(F.col(keys[0]).isNull()).select(
        *[F.col(k).cast("string").alias(k) for k in keys], F.col(ts).cast("bigint").alias(ts), F.col(seq).cast("bigint").alias(seq),
        *probe_fields, *[F.lit(None).cast(kinds[n]).alias(n) for n in names])
    return found.unionByName(keyless)
