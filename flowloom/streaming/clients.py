"""Streaming forms of the client-state operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.operators import location, nmsp
from flowloom.streaming.asof import stream_asof


#: an association counts for INFO_TTL; the store keeps it so many times as long, for records that come late
KEPT = 2


def stream_nmsp(df: DataFrame, limit: int = nmsp.RSSI_LIMIT, now: Column | None = None) -> DataFrame:
    """Measure records of a stream judged against the associations seen so far (``_publish``, ``_stale`` kept)."""
    info = nmsp.info_state(nmsp.nmsp_info(df, now))
    measures = df.filter((F.col("type") == "measure") & (F.size("ap_mac") > 0) & (F.size("rssi") > 0))
    measures = measures.withColumn("_now", nmsp.arrival(df, now).cast("bigint"))
    measures = measures.withColumn("timestamp", F.coalesce(F.col("timestamp").cast("bigint"), F.col("_now")))
    spare = [c for c in (*nmsp.INFO_FIELDS, "dot11_status", "vlan_id") if c in measures.columns]
    paired = stream_asof(measures.drop(*spare), {"_info": info}, nmsp.KEYS, ttl_seconds=KEPT * nmsp.INFO_TTL)
    return nmsp.judge_measures(paired, limit)


def stream_location(df: DataFrame, now: Column | None = None, sticky: bool = True) -> DataFrame:
    """Version 10 records of a stream, completed from the client's state."""
    rows = location.notifications(df, now)
    for c in location.STATE_FIELDS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    fields = location.STATE_FIELDS
    alone = location.without_client(rows)
    rows = rows.filter(F.col("client_mac").isNotNull()).withColumn(
        "_ns", F.coalesce(F.concat(F.lit("="), F.col("namespace_uuid")), F.lit("")))
    schema = rows.schema

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(["timestamp", "event_id", "_pos"], ignore_index=True)
        # the stored record counts as the row before the first one
        seed = list(state.get) if state.exists else None
        n = len(pdf)
        reset = pdf["_reset"].to_numpy(bool)
        run = np.cumsum(reset)  # 0: before the batch's first reset
        at, left = np.arange(n), []
        if seed is None:
            status = pdf["dot11_status"].to_numpy(object, copy=True)
            status[run == 0] = "PROBING"
            pdf["dot11_status"] = status
        for i, name in enumerate(fields):
            col = pdf[name].to_numpy(object)
            there = np.flatnonzero(pdf[name].notna().to_numpy())
            carried = seed[i] if seed is not None else None
            seen = np.full(n, None, object)
            if sticky:
                # the first value of a run, from its row on
                first = np.full(run[-1] + 1, n)
                first[run[there[::-1]]] = there[::-1]
                found = first[run]
                hit = found <= at
            else:
                # the latest value, if it is of the same run
                found = np.full(n, -1)
                found[there] = there
                found = np.maximum.accumulate(found)
                hit = (found >= 0) & (run[found] == run)
            seen[hit] = col[found[hit]]
            if carried is not None:
                seen[(run == 0) if sticky else (run == 0) & ~hit] = carried
            pdf[name] = seen
            left.append(seen[-1])
        state.update(tuple(left))
        yield pdf[[f.name for f in schema]]

    followed = rows.groupBy("client_mac", "_ns").applyInPandasWithState(
        follow, schema, ", ".join(f"{c} string" for c in fields), "append", GroupStateTimeout.NoTimeout)
    return location.shape_v10(followed.drop("_ns").unionByName(alone))

