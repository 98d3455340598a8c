"""Association (info) and signal (measure) records of the wireless controllers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.fields import SITE_DIMS
from flowloom.functions.text import client_profile, rssi_label, strongest_ap
from flowloom.operators.asof import asof_lookup, state_columns

INFO_TTL = 3600
RSSI_LIMIT = -80

# Fields an association leaves behind for its client.
INFO_FIELDS = ["wireless_station", "wireless_channel", "wireless_id", "dot11_protocol"]
KEYS = ["client_mac", "namespace_uuid"]


def arrival(df: DataFrame, now: Column | None = None) -> Column:
    """Processing time of a record: ``now``, else an ``arrival`` column, else its own time, else the clock."""
    if now is not None:
        return now
    given = [F.col(c) for c in ("arrival", "timestamp") if c in df.columns]
    return F.coalesce(*given, F.unix_timestamp())


def _maybe(df: DataFrame, name: str, kind: str = "string") -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)


def _site(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in SITE_DIMS if c in df.columns]


def nmsp_info(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Association records: AP, SSID and VLAN of a client, profile ``hard``."""
    info = df.filter(F.col("type") == "info")
    at = F.coalesce(F.col("timestamp"), arrival(df, now)).cast("bigint")
    return info.select(
        *[c for c in ("event_id",) if c in df.columns],
        at.alias("timestamp"),
        F.lit("nmsp-info").alias("type"),
        "client_mac",
        _maybe(df, "namespace_uuid"),
        *[_maybe(df, c) for c in INFO_FIELDS],
        _maybe(df, "vlan_id", "int").alias("lan_vlan"),
        at.alias("last_seen"),
        F.lit("ASSOCIATED").alias("dot11_status"),
        F.lit("hard").alias("client_profile"),
        *_site(df),
    )


def info_state(info: DataFrame) -> DataFrame:
    """What :func:`nmsp_info` rows leave in the client's ``nmsp-info`` state."""
    return info.select(*KEYS, "timestamp", "event_id", *INFO_FIELDS, "lan_vlan", "last_seen", "dot11_status")


def pair_with_info(df: DataFrame, info: DataFrame, now: Column | None = None) -> DataFrame:
    """Measure records with readings, each with the latest association known at its time."""
    measures = df.filter(
        (F.col("type") == "measure") & (F.size("ap_mac") > 0) & (F.size("rssi") > 0)
    ).withColumns({"_now": arrival(df, now).cast("bigint")})
    measures = measures.withColumn("timestamp", F.coalesce(F.col("timestamp").cast("bigint"), F.col("_now")))
    spare = [c for c in (*INFO_FIELDS, "dot11_status", "vlan_id", "lan_vlan", "last_seen") if c in measures.columns]
    # both inputs are cut from df, so its keys show which clients are hot
    return asof_lookup(measures.drop(*spare), {"_info": info}, KEYS, count_on=[df])


def judge_measures(paired: DataFrame, limit: int = RSSI_LIMIT) -> DataFrame:
    """Decide station, signal and status of every paired measure.

    A fresh association whose AP was heard gives that AP's reading and ``ASSOCIATED``; a fresh one whose
    AP was not heard drops the record; otherwise the strongest AP is taken as ``PROBING``. ``_publish``
    is false for readings too weak to send on, which still count and still update state. ``_stale``
    marks records that found an expired association.
    """
    info = F.col("_info")
    fresh = F.coalesce(info.last_seen + INFO_TTL > F.col("_now"), F.lit(False))
    heard = F.coalesce(F.array_contains("ap_mac", info.wireless_station), F.lit(False))
    place = F.array_position("ap_mac", info.wireless_station).cast("int") - 1
    best = strongest_ap(F.col("ap_mac"), F.col("rssi"))
    rows = paired.withColumns({
        "_joined": fresh & heard, "_lost": fresh & ~heard, "_stale": info.isNotNull() & ~fresh,
    }).filter(~F.col("_lost"))
    joined = F.col("_joined")
    rows = rows.withColumns({
        "client_rssi_num": F.when(joined, F.get("rssi", place)).otherwise(best.rssi),
        "wireless_station": F.when(joined, info.wireless_station).otherwise(best.ap),
    })
    rssi = F.col("client_rssi_num")
    status = F.when(joined, "ASSOCIATED").otherwise("PROBING")
    from_info = lambda c: F.when(joined, info[c]).alias(c)
    return rows.select(
        "event_id", "timestamp",
        F.lit("nmsp-measure").alias("type"),
        *KEYS,
        "client_rssi_num", "wireless_station",
        *[from_info(c) for c in INFO_FIELDS[1:]], from_info("lan_vlan"), from_info("last_seen"),
        rssi_label(rssi).alias("client_rssi"),
        client_profile(rssi).alias("client_profile"),
        status.alias("dot11_status"),
        *_site(paired),
        ((rssi >= limit) | joined).alias("_publish"),
        "_stale",
    )


def nmsp_measure(df: DataFrame, info: DataFrame, limit: int = RSSI_LIMIT, now: Column | None = None) -> DataFrame:
    """Published measure records; ``info`` is :func:`info_state` (batch form)."""
    judged = judge_measures(pair_with_info(df, info, now), limit)
    return judged.filter("_publish").drop("_publish", "_stale")


MEASURE_FIELDS = [
    "client_rssi_num", "wireless_station", *INFO_FIELDS[1:], "lan_vlan", "last_seen", "client_rssi", "client_profile",
]


def client_history(info: DataFrame, judged: DataFrame) -> list[DataFrame]:
    """``nmsp-measure`` and ``nmsp-info`` states over time, for :func:`asof_lookup`'s ``shared``.

    Judged records leave their own state, weak ones included and always with status ASSOCIATED; one that
    found an expired association also removes it.
    """
    place = [*KEYS, "timestamp", "event_id"]
    fields = ["wireless_station", *INFO_FIELDS[1:], "lan_vlan", "last_seen", "dot11_status"]
    left = judged.withColumn("dot11_status", F.lit("ASSOCIATED"))
    removed = F.when(F.col("_stale"), F.struct(F.lit(True).alias("_gone"), *fields))
    return [
        left.select(*place, *state_columns(left, {"nmsp-measure": [*MEASURE_FIELDS, "dot11_status"]}).values(),
                    removed.alias("nmsp-info")),
        info.select(*place, *state_columns(info, {"nmsp-info": fields}).values()),
    ]
