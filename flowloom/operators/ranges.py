"""Address-range and nested-interval lookups as equi-joins.

Every range is filed once under the longest hexadecimal prefix its two ends share. A point can only lie
in ranges filed under one of its own prefixes, so it probes each prefix length with an equality join and
checks the bounds of the few ranges found there: ranges that do not overlap and share the same longest
prefix differ in the next digit, so a prefix holds at most 15 of them. No range is cut into many buckets,
no cross join is needed, and overlapping ranges are still answered exactly (the narrowest wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.address import fixed_hex, ip_key
from flowloom.functions.text import as_name
from flowloom.operators.lookup import Enricher, merge_columns


def shared_prefix(a: Column, b: Column, width: int) -> Column:
    """Longest common prefix of two texts of at most ``width`` characters."""
    same = F.filter(
        F.sequence(F.lit(1), F.lit(width)), lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n))
    return F.substring(a, F.lit(1), F.size(same))


def stab(points: DataFrame, intervals: DataFrame, width: int, least: int = 0) -> DataFrame:
    """Pairs of points and the closed intervals around them.

    No interval is filed under fewer than ``least`` digits (1 where the first digit is a family), so no probe is made there.

    ``points`` has a text column ``point``; ``intervals`` has ``lo`` and ``hi`` of the same fixed width
    (per leading family digit) plus payload columns.
    """
    filed = intervals.filter(F.col("lo").isNotNull() & (F.col("lo") <= F.col("hi"))).withColumn(
        "_prefix", shared_prefix(F.col("lo"), F.col("hi"), width)
    )
    probes = points.filter(F.col("point").isNotNull()).withColumn(
        "_n", F.explode(F.sequence(F.lit(least), F.length("point")))
    ).withColumn("_probe", F.substring(F.col("point"), F.lit(1), F.col("_n")))
    hit = (F.col("_probe") == F.col("_prefix")) & F.col("point").between(F.col("lo"), F.col("hi"))
    return probes.join(filed, hit, "inner").drop("_n", "_probe", "_prefix")


def range_table(df: DataFrame, value: str) -> DataFrame:
    """Normalise ``(start, end, family, value)`` to sortable text bounds.

    ``start`` and ``end`` may be address text or, for version 4, whole numbers. Rows whose bounds contradict their
    ``family`` (numeric bounds of version 6, say) get no bounds and match nothing.
    """
    def bound(name: str) -> Column:
        if df.schema[name].dataType.typeName() in ("long", "integer"):
            key = F.concat(F.lit("4"), fixed_hex(F.col(name).cast("bigint"), 8))
        else:
            key = ip_key(F.col(name))
        if "family" not in df.columns:
            return key
        family = F.col("family").cast("string")
        return F.when(family.isNull() | (F.substring(key, 1, 1) == family), key)
    return df.select(bound("start_ip").alias("lo"), bound("end_ip").alias("hi"), F.col(value).alias("_value"))


def address_values(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(ip, _value)`` for distinct addresses; the narrowest range wins: latest start, then earliest end."""
    points = addresses.select("ip", ip_key(F.col("ip")).alias("point"))
    pairs = stab(points, ranges, 33, least=1)
    # digits turned round, so that an earlier end sorts higher
    early = F.translate("hi", "0123456789abcdef", "fedcba9876543210")
    return pairs.groupBy("ip").agg(F.max_by("_value", F.struct(F.col("lo"), early, F.col("_value"))).alias("_value"))


def geo_lookup(df: DataFrame, country_ranges: DataFrame | None, asn_ranges: DataFrame | None,
               lan: str = "lan_ip", wan: str = "wan_ip", addresses_of: DataFrame | None = None,
               row_id: str | None = None) -> DataFrame:
    """Country code and network owner of both addresses.

    ``country_ranges`` is ``(start_ip, end_ip, family, country_code)`` and ``asn_ranges``
    ``(start_ip, end_ip, family, as_info)``; a missing table adds nothing. The ``ip_*`` columns and
    ``public_ip`` come from the WAN side when it is known there, else from the LAN side. Each distinct
    address is looked up once; ``addresses_of`` may name a cheaper frame that holds all of them, such as
    the records before earlier joins. ``row_id`` names a column, never NULL, that tells records apart (in ``addresses_of``
    too, where given): the sides then meet on narrow rows, without those that have no address, and wide records are joined
    once instead of once per side.
    """
    sides = [c for c in (lan, wan) if c in df.columns]
    if not sides or (country_ranges is None and asn_ranges is None):
        return df
    source = df if addresses_of is None else addresses_of
    own = [row_id] if row_id else []
    uses = source.select(*own, F.posexplode(F.array(*sides)).alias("_side", "ip")).filter(F.col("ip").isNotNull())
    addresses = uses.select("ip").distinct()
    known = addresses
    for table, value, name in ((country_ranges, "country_code", "_cc"), (asn_ranges, "as_info", "_as")):
        if table is None:
            known = known.withColumn(name, F.lit(None).cast("string"))
        else:
            values = address_values(addresses, range_table(table, value)).withColumnRenamed("_value", name)
            known = known.join(values, "ip", "left")
    known = known.withColumn("_as", as_name(F.col("_as"))).filter(
        F.coalesce("_cc", "_as").isNotNull())
    if row_id:
        value = lambda name, i: F.max(F.when(F.col("_side") == i, F.col(name)))
        # broadcast, the uses of a small file would all be met in the few tasks that hold the addresses
        met = uses.hint("merge").join(known, "ip").groupBy(F.col(row_id).alias("_row")).agg(
            *[value(n, i).alias(f"{n}_{s}") for i, s in enumerate(sides) for n in ("_cc", "_as")])
        df = df.join(met, F.col(row_id) == F.col("_row"), "left").drop("_row")
    else:
        for side in sides:
            dim = known.select(F.col("ip").alias(f"_{side}"), F.col("_cc").alias(f"_cc_{side}"), F.col("_as").alias(f"_as_{side}"))
            df = df.join(dim, F.col(side) == F.col(f"_{side}"), "left").drop(f"_{side}")
    found: dict[str, Column] = {}
    for side in sides:
        found[f"{side}_country_code"] = F.col(f"_cc_{side}")
        found[f"{side}_as_name"] = F.col(f"_as_{side}")
    latest = list(reversed(sides))
    found["ip_country_code"] = F.coalesce(*[F.col(f"_cc_{s}") for s in latest])
    found["ip_as_name"] = F.coalesce(*[F.col(f"_as_{s}") for s in latest])
    found["public_ip"] = F.coalesce(*[F.when(F.col(f"_cc_{s}").isNotNull(), F.col(s)) for s in latest])
    out = merge_columns(df, found, True)
    return out.drop(*[f"_{t}_{s}" for t in ("cc", "as") for s in sides])


def geo_enricher(country_ranges: DataFrame | None, asn_ranges: DataFrame | None,
                 addresses_of: DataFrame | None = None, row_id: str | None = None) -> Enricher:
    fn = lambda df: geo_lookup(df, country_ranges, asn_ranges, addresses_of=addresses_of, row_id=row_id)
    fn.fills = ("lan_ip_country_code", "wan_ip_country_code", "lan_ip_as_name", "wan_ip_as_name",
                "ip_country_code", "ip_as_name", "public_ip")
    return fn
