"""Location feeds: version 8/9 streaming notifications, version 10 notification lists, cloud controllers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from flowloom.fields import SITE_DIMS
from flowloom.functions.text import (
    RSSI_TOP_CLOUD, client_profile, iso_seconds, latlng, rssi_label, status_name, zone_path,
)
from flowloom.operators.asof import HOT_ROWS, cut_chunks, fill_group, fill_last

KEYS = ["client_mac", "namespace_uuid"]
# What a location record leaves behind for its client.
STATE_FIELDS = [
    "wireless_id", "dot11_protocol", "dot11_status", "wireless_station", "client_id",
    "campus", "building", "floor", "zone", "client_latlong",
]
# sorts before every reset
NO_RESET = "named_struct('timestamp', -9223372036854775808, 'event_id', -9223372036854775808, '_pos', -1)"
# Site dimensions an association passes on (it carries no namespace or provider).
ASSOCIATION_DIMS = SITE_DIMS[:8]

# The two releases name these objects differently in letter case only, so each gets its own parse.
_GEO = "struct<latitude: double, lattitude: double, longitude: double>"
_MAP = "struct<mapHierarchyString: string>"
_LOCATION_8 = (
    f"macAddress string, ssId string, band string, apMacAddress string, dot11Status string, "
    f"ipAddress array<string>, GeoCoordinate {_GEO}, MapInfo {_MAP}"
)
_LOCATION_9 = f"geoCoordinate {_GEO}, mapInfo {_MAP}"
_NOTIFICATION = ", ".join([
    "notificationType string", "subscriptionName string", "deviceId string", "ssId string", "band string",
    "apMacAddress string", "locationMapHierarchy string", "timestamp bigint", "namespace_uuid string",
    "status int", "username string", *[f"{c} string" for c in SITE_DIMS],
])


def _fields(kind: StructType) -> set[str]:
    return {f.name for f in kind.fields}


def _coalesce(*cols: Column | None) -> Column:
    there = [c for c in cols if c is not None]
    return F.coalesce(*there) if there else F.lit(None)


def location_v89(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Version 8/9 record: position, zone path and (only when ASSOCIATED) SSID, AP and first address.

    ``StreamingNotification.location`` may be JSON text or a struct.
    """
    body_type = df.schema["StreamingNotification"].dataType
    body = F.col("StreamingNotification")
    df = df.filter(body.isNotNull())
    if isinstance(body_type["location"].dataType, StringType):
        df = df.withColumn("_l8", F.from_json(body.location, _LOCATION_8))
        incomplete = F.col("_l8.GeoCoordinate").isNull() | F.col("_l8.MapInfo").isNull()
        df = df.withColumn("_l9", F.when(incomplete, F.from_json(body.location, _LOCATION_9)))
        geo = F.coalesce(F.col("_l8.GeoCoordinate"), F.col("_l9.geoCoordinate"))
        info = F.coalesce(F.col("_l8.MapInfo"), F.col("_l9.mapInfo"))
        have = None
    else:
        df = df.withColumn("_l8", body.location)
        have = _fields(body_type["location"].dataType)
        part = lambda *names: _coalesce(*[F.col(f"_l8.{n}") for n in names if n in have])
        geo, info = part("GeoCoordinate", "geoCoordinate"), part("MapInfo", "mapInfo")
    loc = lambda name, kind="string": (
        F.col(f"_l8.{name}") if have is None or name in have else F.lit(None).cast(kind))
    df = df.withColumns({"_geo": geo, "_zone": zone_path(info.mapHierarchyString, 3)})
    geo_have = _fields(df.schema["_geo"].dataType)
    lat = _coalesce(*[F.col(f"_geo.{n}") for n in ("latitude", "lattitude") if n in geo_have])

    status = loc("dot11Status")
    joined = status == "ASSOCIATED"
    when_joined = lambda c: F.when(joined, c)
    body_have = _fields(body_type)
    inner = lambda n: F.col(f"StreamingNotification.{n}") if n in body_have else None
    outer = lambda n: F.col(n) if n in df.columns else None
    dims = {n: _coalesce(outer(n), inner(n)) for n in SITE_DIMS if outer(n) is not None or inner(n) is not None}
    subscription = inner("subscriptionName")
    if subscription is not None or "sensor_name" in dims:
        dims["sensor_name"] = _coalesce(dims.get("sensor_name"), subscription)
    clock = now if now is not None else F.unix_timestamp()
    return df.select(
        *[c for c in ("event_id",) if c in df.columns],
        F.when(F.col("StreamingNotification.timestamp").isNull(), clock)
        .otherwise(iso_seconds(F.col("StreamingNotification.timestamp"))).cast("bigint").alias("timestamp"),
        F.lit("mse").alias("type"),
        loc("macAddress").alias("client_mac"),
        (F.col("namespace_uuid") if "namespace_uuid" in df.columns else F.lit(None)).cast("string").alias("namespace_uuid"),
        F.col("_zone.campus").alias("campus"), F.col("_zone.building").alias("building"), F.col("_zone.floor").alias("floor"),
        status.alias("dot11_status"),
        when_joined(loc("ssId")).alias("wireless_id"),
        when_joined(loc("apMacAddress")).alias("wireless_station"),
        when_joined(F.get(loc("ipAddress", "array<string>"), F.lit(0))).alias("lan_ip"),
        latlng(lat, F.col("_geo.longitude")).alias("client_latlong"),
        F.lit("unknown").alias("client_rssi"),
        F.lit("unknown").alias("client_snr"),
        F.lit("hard").alias("client_profile"),
        *[c.alias(n) for n, c in dims.items()],
    )


def v89_state(rows: DataFrame) -> DataFrame:
    """``location`` state left by version 8/9 records."""
    own = ["campus", "building", "floor", "dot11_status", "wireless_id", "wireless_station", "client_latlong"]
    return rows.filter(F.col("client_mac").isNotNull()).select(*KEYS, "timestamp", "event_id", *own)


def notifications(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Version 10 notification lists to one row per known notification, each handled once.

    List elements may be JSON text or structs. Text is needed when both ``ssId`` (read from associations)
    and ``ssid`` (read from updates) occur, because column names ignore letter case.
    """
    kind = df.schema["notifications"].dataType.elementType
    ids = [c for c in ("event_id",) if c in df.columns]
    rows = df.select(*ids, F.posexplode("notifications").alias("_pos", "n"))
    if isinstance(kind, StringType):
        rows = rows.withColumns({"_u": F.from_json("n", "ssid string"), "n": F.from_json("n", _NOTIFICATION)})
        have = {f.split()[0] for f in _NOTIFICATION.split(", ")}
        update_ssid = F.col("_u.ssid")
    else:
        have = _fields(kind)
        update_ssid = F.col("n.ssid") if "ssid" in have else F.lit(None)
    part = lambda name, to="string": (F.col(f"n.{name}") if name in have else F.lit(None)).cast(to)
    rows = rows.filter(part("notificationType").isin("association", "locationupdate"))
    assoc = part("notificationType") == "association"
    clock = now if now is not None else F.unix_timestamp()
    seconds = F.floor(part("timestamp", "bigint") / 1000)
    zone = zone_path(part("locationMapHierarchy"), 4)
    return rows.select(
        *ids, "_pos",
        assoc.alias("_reset"),
        F.when(assoc, seconds).otherwise(F.coalesce(seconds, clock)).alias("timestamp"),
        part("deviceId").alias("client_mac"),
        part("namespace_uuid").alias("namespace_uuid"),
        F.when(assoc, part("ssId")).otherwise(update_ssid).alias("wireless_id"),
        F.when(assoc, part("band")).alias("dot11_protocol"),
        F.when(assoc, status_name(part("status", "int"))).alias("dot11_status"),
        part("apMacAddress").alias("wireless_station"),
        F.when(assoc & (part("username") != ""), part("username")).alias("client_id"),
        *[F.when(~assoc, zone[c]).alias(c) for c in ("campus", "building", "floor", "zone")],
        part("subscriptionName").alias("subscriptionName"),
        *[part(c).alias(c) for c in SITE_DIMS if c in have],
    )


def follow_clients(rows: DataFrame, resets: DataFrame | None = None, sticky: bool = True,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Complete every row's state fields from the client's earlier records.

    An association (or a row of ``resets``: :func:`v89_state`, :func:`meraki_state`) starts afresh. With
    ``sticky`` a field keeps the first value seen since then; otherwise the newest value counts. Updates
    before any reset are ``PROBING``. The result has the columns of ``rows``, and ``resets`` rows vanish. Rows without
    a client MAC neither leave nor see state.
    """
    extra = [c for c in STATE_FIELDS if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in extra})
    alone = without_client(rows)
    rows = rows.filter(F.col("client_mac").isNotNull()).withColumn("_keep", F.lit(True))
    if resets is not None:
        r = resets.filter(F.col("client_mac").isNotNull()).select(
            *[F.col(k).cast("string").alias(k) for k in KEYS], "timestamp", "event_id", F.lit(-1).alias("_pos"),
            *[F.col(c).cast("string").alias(c) for c in STATE_FIELDS if c in resets.columns],
            F.lit(True).alias("_reset"), F.lit(False).alias("_keep"),
        )
        rows = rows.unionByName(r, allowMissingColumns=True)
    order = ["timestamp", "event_id", "_pos"]
    columns = [c for c in rows.columns if c != "_keep"]
    rows = rows.withColumn("_since", F.when(F.col("_reset"), F.struct(*order)))
    rows, chunk = cut_chunks(rows, KEYS, order, block_on="event_id", hot_rows=hot_rows)
    rows = fill_last(rows, chunk, order, ["_since"])
    rows = rows.withColumns({"_unseen": F.col("_since").isNull(), "_since": F.coalesce("_since", F.expr(NO_RESET))})
    rows = fill_group(rows, chunk, order, STATE_FIELDS, "_since", first=sticky)
    status = F.when(F.col("_unseen"), F.lit("PROBING")).otherwise(F.col("dot11_status"))
    return rows.filter("_keep").withColumn("dot11_status", status).select(*columns).unionByName(alone.select(*columns))


def without_client(rows: DataFrame) -> DataFrame:
    """The rows that carry no client MAC, as they are when there is no state for them."""
    status = F.when(F.col("_reset"), F.col("dot11_status")).otherwise(F.lit("PROBING"))
    return rows.filter(F.col("client_mac").isNull()).withColumn("dot11_status", status)


def shape_v10(rows: DataFrame) -> DataFrame:
    """Output form of followed version 10 rows."""
    assoc = F.col("_reset")
    have = rows.columns
    dims = []
    for c in SITE_DIMS:
        own = F.col(c) if c in have else F.lit(None).cast("string")
        if c not in ASSOCIATION_DIMS:
            own = F.when(~assoc, own)
        if c == "sensor_name":
            own = F.coalesce(own, F.col("subscriptionName"))
        if c in have or c == "sensor_name":
            dims.append(own.alias(c))
    return rows.select(
        *[c for c in ("event_id",) if c in have],
        "timestamp",
        F.when(assoc, "mse10-association").otherwise("mse10-location").alias("type"),
        "client_mac",
        F.when(~assoc, F.col("namespace_uuid")).alias("namespace_uuid"),
        *STATE_FIELDS,
        F.when(assoc, "hard").alias("client_profile"),
        "subscriptionName",
        *dims,
    )


def location_v10(df: DataFrame, resets: DataFrame | None = None, sticky: bool = True,
                 now: Column | None = None) -> DataFrame:
    """Version 10 associations and updates, completed from earlier records of the client."""
    return shape_v10(follow_clients(notifications(df, now), resets, sticky))


def v10_state(followed: DataFrame) -> DataFrame:
    """``location`` state left by followed version 10 rows."""
    return followed.select(*KEYS, "timestamp", "event_id", *STATE_FIELDS)


def location(df: DataFrame, sticky: bool = True, now: Column | None = None) -> DataFrame:
    """Both feeds of one topic, told apart by the key present; anything else is left out.

    Version 8/9 rows reset what version 10 updates remember.
    """
    old = df.filter(F.col("StreamingNotification").isNotNull())
    new = df.filter(F.col("StreamingNotification").isNull() & F.col("notifications").isNotNull())
    v89 = location_v89(old, now)
    v10 = location_v10(new, v89_state(v89) if "event_id" in df.columns else None, sticky, now)
    return v89.unionByName(v10, allowMissingColumns=True)


def meraki(df: DataFrame, top_label: str = RSSI_TOP_CLOUD) -> DataFrame:
    """Cloud-controller record: every field kept, status from the presence of ``src``."""
    rssi = F.col("client_rssi_num").cast("int") if "client_rssi_num" in df.columns else F.lit(None).cast("int")
    src = F.col("src") if "src" in df.columns else F.lit(None)
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.filter(F.col("client_mac").isNotNull()).withColumns({
        "dot11_status": F.when(src.isNotNull(), "ASSOCIATED").otherwise("PROBING"),
        "client_rssi": F.coalesce(rssi_label(rssi, top_label), own("client_rssi")),
        "client_profile": F.coalesce(client_profile(rssi), own("client_profile")),
    })


def meraki_state(rows: DataFrame) -> DataFrame:
    """``location`` state left by cloud-controller records, keyed by the bare MAC."""
    keep = [c for c in rows.columns if c not in ("namespace_uuid", "timestamp", "event_id", "client_mac")]
    return rows.select("client_mac", F.lit(None).cast("string").alias("namespace_uuid"), "timestamp", "event_id", *keep)
