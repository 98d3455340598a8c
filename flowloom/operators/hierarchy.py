"""Site tables: access-point locations from the nested-set sensor tree, sensor positions, salts, deltas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.address import fixed_hex
from flowloom.functions.text import latlng
from flowloom.operators.ranges import stab

# Tree level name and its domain type.
LEVELS = {
    "floor": 101,
    "building": 5,
    "campus": 4,
    "deployment": 7,
    "namespace": 8,
    "market": 3,
    "organization": 2,
    "service_provider": 6,
}
PROVIDER = LEVELS["service_provider"]
SALT_FIELD = "mac_hashing_salt"


def ancestors(sensors: DataFrame) -> DataFrame:
    """One row per sensor: ``<level>`` name and ``<level>_uuid`` of the enclosing node at each level.

    A node encloses a sensor when its ``[lft, rgt]`` covers the sensor's. With several at one level the
    smallest id is taken. Containment is found by prefix equality, not by comparing all pairs.
    """
    # as many digits as the positions' type needs: every digit less is a probe less for each sensor
    width = 8 if sensors.schema["lft"].dataType.typeName() == "integer" and sensors.schema["rgt"].dataType.typeName() == "integer" else 16
    # nodes and sensors may lie on one another: each place is asked for once, and a place has one node per level that can win
    places = sensors.select("lft", F.col("rgt").alias("_rgt")).distinct()
    points = places.select("lft", "_rgt", fixed_hex(F.col("lft").cast("bigint"), width).alias("point"))
    nodes = sensors.filter(F.col("domain_type").isin(list(LEVELS.values()))).groupBy("lft", "rgt", "domain_type").agg(
        F.min(F.struct("id", "name", "uuid")).alias("_node")
    ).select(
        fixed_hex(F.col("lft").cast("bigint"), width).alias("lo"),
        fixed_hex(F.col("rgt").cast("bigint"), width).alias("hi"),
        F.col("rgt").alias("_node_rgt"), F.col("domain_type").alias("_level"), "_node",
    )
    pairs = stab(points, nodes, width).filter(F.col("_node_rgt") >= F.col("_rgt"))
    around = pairs.groupBy("lft", "_rgt").agg(*[
        F.min(F.when(F.col("_level") == code, F.col("_node"))).alias(level) for level, code in LEVELS.items()
    ])
    own = sensors.select(F.col("id").alias("_sensor"), F.col("lft").alias("_lft"), F.col("rgt").alias("_own_rgt"))
    found = own.join(around, (F.col("_lft") == F.col("lft")) & (F.col("_own_rgt") == F.col("_rgt"))).groupBy("_sensor").agg(
        *[F.min(level).alias(level) for level in LEVELS])
    return found.select(
        "_sensor",
        *[F.col(f"{level}.name").alias(level) for level in LEVELS],
        *[F.col(f"{level}.uuid").alias(f"{level}_uuid") for level in LEVELS],
    )


def site_dimension(aps: DataFrame, sensors: DataFrame, zones: DataFrame | None = None,
                   bridge: DataFrame | None = None) -> DataFrame:
    """One row per access-point MAC with its place in the tree.

    Access points without a sensor are dropped; of several rows for one MAC the smallest id is kept.
    Columns of the tree override the access point's JSON ``enrichment``; the rounded position comes last.
    JSON keys that are not tree columns land in ``extras``.
    """
    sensor_ids = sensors.select(F.col("id").alias("_sensor"))
    cols = [c for c in ("ip_address", "enrichment", "latitude", "longitude", "sensor_id") if c in aps.columns]
    placed = aps.join(sensor_ids, F.col("sensor_id") == F.col("_sensor"), "left_semi")
    one = placed.groupBy("mac_address").agg(
        F.min_by(F.struct("id", *cols), F.col("id")).alias("_ap")
    ).select("mac_address", "_ap.*")
    out = one.join(ancestors(sensors), F.col("sensor_id") == F.col("_sensor"), "left")
    if zones is not None and bridge is not None:
        named = bridge.join(zones.select(F.col("id").alias("_zone"), F.col("name").alias("_zone_name")),
                            F.col("zone_id") == F.col("_zone"), "inner")
        first = named.groupBy(F.col("access_point_id").alias("_ap_id")).agg(
            F.min(F.struct(F.col("_zone"), F.col("_zone_name"))).alias("_z"))
        out = out.join(first, F.col("id") == F.col("_ap_id"), "left").withColumns({
            "zone": F.col("_z._zone_name"), "zone_uuid": F.col("_z._zone").cast("string")}).drop("_z", "_ap_id")
    else:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("zone", "zone_uuid")})

    places = [*LEVELS, "zone", *[f"{n}_uuid" for n in LEVELS], "zone_uuid"]
    position = latlng(F.col("latitude"), F.col("longitude"))
    if "enrichment" in cols:
        given = F.from_json("enrichment", "map<string,string>")
        out = out.withColumn("_json", given)
        pick = lambda c: F.try_element_at(F.col("_json"), F.lit(c))
        out = out.withColumns({c: F.coalesce(F.col(c), pick(c)) for c in places})
        position = F.coalesce(pick("client_latlong"), position)
        known = places + ["client_latlong"]
        extras = F.map_filter("_json", lambda k, _: ~k.isin(known))
    else:
        extras = F.lit(None).cast("map<string,string>")
    return out.select("mac_address", *places, position.alias("client_latlong"), extras.alias("extras"))


def as_station_table(site: DataFrame) -> DataFrame:
    """Site table keyed by ``wireless_station``, ready for a :class:`StoreSpec`."""
    return site.withColumnRenamed("mac_address", "wireless_station").drop("extras")


def sensor_locations(sensors: DataFrame) -> DataFrame:
    """``(sensor_uuid, client_latlong)``; only positions written with digits alone are accepted."""
    digits = lambda c: F.col(c).cast("string").rlike("^[0-9]+$")
    return sensors.filter(F.col("uuid").isNotNull() & digits("latitude") & digits("longitude")).select(
        F.col("uuid").alias("sensor_uuid"), latlng(F.col("latitude"), F.col("longitude")).alias("client_latlong")
    )


def provider_salts(sensors: DataFrame) -> DataFrame:
    """``(uuid, salt)`` of the service providers that have one."""
    salt = F.get_json_object("property", f"$.{SALT_FIELD}")
    return sensors.filter(F.col("domain_type") == PROVIDER).select("uuid", salt.alias("salt")).filter(
        F.col("salt").isNotNull())


def snapshot_delta(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes between two snapshots: keys and ``change`` in ``added``/``removed``/``changed``."""
    keys = list(keys)
    fields = [c for c in new.columns if c not in keys]
    side = lambda df, tag: df.select(*[F.col(k).alias(f"_{tag}_{k}") for k in keys], F.struct(*fields, F.lit(True).alias("_there")).alias(f"_{tag}"))
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    both = side(old, "old").join(side(new, "new"), same, "full")
    there = lambda tag: F.col(f"_{tag}._there").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col(f"_new.`{c}`").eqNullSafe(F.col(f"_old.`{c}`")) for c in fields], F.lit(False))
    change = F.when(~there("old"), "added").when(~there("new"), "removed").when(differs, "changed")
    own = [F.when(there("new"), F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")).alias(k) for k in keys]
    return both.select(*own, change.alias("change")).filter(F.col("change").isNotNull())
