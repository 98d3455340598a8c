"""MAC and IP address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted address shapes.
IPV4 = r"^(([01]?\d\d?|2[0-4]\d|25[0-5])\.){3}([01]?\d\d?|2[0-4]\d|25[0-5])$"
STATION = r"^((?:[0-9a-fA-F]{2}[:-]){5}[0-9a-fA-F]{2})[:-](.*)"
# One to eight 16-bit groups with at most one '::', optionally ending in a dotted quad.
IPV6_CHARS = r"^[0-9a-f:]+(\d{1,3}(\.\d{1,3}){3})?$"


def mac_norm(mac: Column) -> Column:
    return F.lower(F.regexp_replace(mac, "-", ":"))


def oui(mac: Column) -> Column:
    """Vendor prefix: first six hex digits in upper case; NULL for shorter text."""
    bare = F.regexp_replace(F.trim(mac), "[:-]", "")
    return F.when(F.length(bare) >= 6, F.upper(F.substring(bare, 1, 6)))


def station_parse(called: Column) -> Column:
    """``AA:..:FF:SSID`` to ``struct<station, ssid>``, both NULL without a separator after the MAC."""
    hit = called.rlike(STATION)
    return F.struct(
        F.when(hit, mac_norm(F.regexp_extract(called, STATION, 1))).alias("station"),
        F.when(hit, F.regexp_extract(called, STATION, 2)).alias("ssid"),
    )


def ip_family(ip: Column) -> Column:
    """4 for a full dotted quad, 6 for any other text."""
    return F.when(ip.rlike(IPV4), F.lit(4)).when(ip.isNotNull(), F.lit(6))


def ipv4_number(ip: Column) -> Column:
    part = F.split(ip, r"\.")
    octet = [F.get(part, F.lit(i)).try_cast("bigint") for i in range(4)]
    return octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]


def fixed_hex(number: Column, width: int) -> Column:
    """Non-negative integer as lower-case hex of a fixed width, so text order is number order."""
    return F.lower(F.lpad(F.hex(number), width, "0"))


def ipv6_hex(ip: Column) -> Column:
    """32 hex digits of an IPv6 address (``::`` expanded), NULL when it is not one."""
    bare = F.lower(F.trim(ip))
    quad = F.regexp_extract(bare, r"(\d{1,3}(?:\.\d{1,3}){3})$", 1)
    tail = fixed_hex(ipv4_number(quad), 8)
    # a trailing dotted quad stands for the last two groups
    text = F.when(
        quad != "",
        F.concat(
            F.substring(bare, F.lit(1), F.length(bare) - F.length(quad)),
            F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4),
        ),
    ).otherwise(bare)
    halves = F.split(text, "::")
    groups = lambda half: F.filter(F.split(F.coalesce(half, F.lit("")), ":"), lambda g: g != "")
    left, right = groups(F.get(halves, F.lit(0))), groups(F.get(halves, F.lit(1)))
    missing = F.lit(8) - F.size(left) - F.size(right)
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    valid = (
        bare.rlike(IPV6_CHARS)
        & (F.size(halves) <= 2)
        & F.when(F.size(halves) == 2, missing >= 1).otherwise(missing == 0)
        & F.forall(filled, lambda g: F.length(g) <= 4)
    )
    return F.when(valid, F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))


def ip_key(ip: Column) -> Column:
    """Sortable form: family digit, then 8 (v4) or 32 (v6) hex digits; NULL for unreadable text."""
    v4 = F.concat(F.lit("4"), fixed_hex(ipv4_number(ip), 8))
    return F.when(ip.rlike(IPV4), v4).otherwise(F.concat(F.lit("6"), ipv6_hex(ip)))
