"""Flow, event, access-point state, RADIUS and guest-profile records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.fields import SITE_DIMS
from flowloom.functions.address import mac_norm, station_parse
from flowloom.functions.text import flow_duration, whole_number
from flowloom.operators.lookup import Enricher, StoreSpec, enrich_record
from flowloom.operators.split import split_flows


def flow(df: DataFrame, stores: Sequence[StoreSpec] = (), enrichers: Sequence[Enricher] = (),
         now: Column | str = "now", before_split: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Enrich, measure and split flows; ``before_split`` is applied to the whole flows, as :meth:`rollup.Apart.take`."""
    at = F.col(now) if isinstance(now, str) else now
    df = enrich_record(df.withColumn("_at_now", at), stores, enrichers)
    span = flow_duration(whole_number(df, "timestamp"), whole_number(df, "first_switched"), F.col("_at_now"))
    df = df.withColumn("duration", span)
    if before_split is not None:
        df = before_split(df)
    return split_flows(df, F.col("_at_now")).drop("_at_now")


def event(df: DataFrame, stores: Sequence[StoreSpec] = (), enrichers: Sequence[Enricher] = ()) -> DataFrame:
    """Security events pass through with lookups only; looked-up values follow each store's policy."""
    return enrich_record(df, stores, enrichers)


def ap_state(df: DataFrame, stores: Sequence[StoreSpec] = ()) -> DataFrame:
    """Access-point state: store lookups only."""
    return enrich_record(df, stores)


# Accounting attribute and the client field it fills.
RADIUS_CLIENT = {
    "User-Name": "client_id",
    "Operator-Name": "wireless_operator",
    "Airespace-Wlan_Id": "wireless_id",
}
RADIUS_STATE = ["client_id", "wireless_operator", "wireless_id", "wireless_station"]


def radius(df: DataFrame, now: Column | None = None) -> DataFrame:
    """RADIUS accounting records.

    Entries of the ``enrichment`` map override the record's site dimensions; entries that are no column
    of the output go to ``extras``. Records without a calling station are dropped.
    """
    attr = lambda name: F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
    clock = now if now is not None else F.unix_timestamp()
    df = df.filter(attr("Calling-Station-Id").isNotNull()).withColumn(
        "_called", station_parse(attr("Called-Station-Id")))
    given = F.col("enrichment") if "enrichment" in df.columns else F.lit(None).cast("map<string,string>")
    added = lambda c: F.try_element_at(given, F.lit(c))
    client = {field: attr(name) for name, field in RADIUS_CLIENT.items()}
    client["wireless_id"] = F.coalesce(F.col("_called.ssid"), client["wireless_id"])
    client["wireless_station"] = F.col("_called.station")
    site = [*SITE_DIMS, "namespace_uuid"]
    own = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    later = {**client, "sensor_ip": attr("Packet-Src-IP-Address"),
             "client_accounting_type": F.lower(attr("Acct-Status-Type"))}
    known = ["client_mac", *site, *later, "timestamp", "type", "client_profile"]
    return df.select(
        *[c for c in ("id", "event_id") if c in df.columns],
        F.coalesce(F.col("timestamp").cast("bigint"), clock).alias("timestamp"),
        F.lit("radius").alias("type"),
        F.coalesce(added("client_mac"), mac_norm(attr("Calling-Station-Id"))).alias("client_mac"),
        *[F.coalesce(added(c), own(c)).alias(c) for c in site],
        *[F.coalesce(c, added(n)).alias(n) for n, c in later.items()],
        F.lit("hard").alias("client_profile"),
        F.map_filter(given, lambda k, _: ~k.isin(known)).alias("extras"),
        # the client's state is keyed by the record's own MAC and namespace
        mac_norm(attr("Calling-Station-Id")).alias("_state_mac"),
        own("namespace_uuid").alias("_state_ns"),
        *[c.alias(f"_state_{n}") for n, c in client.items()],
        (attr("Acct-Status-Type").isNotNull() & (attr("Acct-Status-Type") == "Stop")).alias("_state_kept"),
    )


def radius_output(rows: DataFrame) -> DataFrame:
    """:func:`radius` rows without the state columns."""
    return rows.drop(*[c for c in rows.columns if c.startswith("_state_")])


def radius_state(rows: DataFrame, seq: str = "event_id") -> DataFrame:
    """``radius`` state of :func:`radius` rows; a Stop record leaves the earlier state as it was."""
    return rows.filter(~F.col("_state_kept")).select(
        F.col("_state_mac").alias("client_mac"), F.col("_state_ns").alias("namespace_uuid"), "timestamp",
        F.col(seq).alias("event_id"), *[F.col(f"_state_{c}").alias(c) for c in RADIUS_STATE])


def guest_profiles(df: DataFrame) -> DataFrame:
    """Guest profile state of property-management records; a staff name beats the guest name."""
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    rows = df.select(
        own("client_mac").alias("client_mac"), own("namespace_uuid").cast("string").alias("namespace_uuid"),
        *[c for c in ("timestamp", "event_id") if c in df.columns],
        F.coalesce(own("staff_name"), own("guest_name")).alias("client_fullname"),
        own("client_gender").alias("client_gender"),
        own("auth_type").alias("client_auth_type"),
        own("client_vip").alias("client_vip"),
        own("client_loyality").alias("client_loyality"),
    )
    return rows.filter(F.coalesce(
        "client_fullname", "client_gender", "client_auth_type", "client_vip", "client_loyality").isNotNull())
