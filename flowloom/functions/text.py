"""Scalar expressions over single records: durations, labels, paths, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signal-strength label limits (upper bound in dBm, label), weakest first.
RSSI_LABELS = [(-85, "bad"), (-80, "low"), (-70, "medium"), (-60, "good")]
RSSI_TOP = "excellent"
#: the cloud-controller feed spells the top label differently
RSSI_TOP_CLOUD = "excelent"

# Client profile limits (upper bound in dBm, profile), weakest first.
PROFILE_LIMITS = [(-75, "soft"), (-65, "medium")]
PROFILE_DEFAULT = "hard"

# 802.11 status codes of the version-10 location feed.
STATUS_NAMES = {
    0: "IDLE",
    1: "AAA_PENDING",
    2: "AUTHENTICATED",
    3: "ASSOCIATED",
    4: "POWERSAVE",
    5: "DISASSOCIATED",
    6: "TO_BE_DELETED",
    7: "PROBING",
    8: "BLACK_LISTED",
    256: "WAIT_AUTHENTICATED",
    257: "WAIT_ASSOCIATED",
}


def as_long(c: Column) -> Column:
    """Whole number or NULL; ``"2.0E9"`` and ``"1.5"`` are not whole numbers."""
    return c.cast("string").try_cast("bigint")


def whole_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a whole number; integer columns are taken as they are, absent ones are NULL."""
    if name not in df.columns:
        return F.lit(None).cast("bigint")
    if df.schema[name].dataType.typeName() in ("long", "integer", "short", "byte"):
        return F.col(name).cast("bigint")
    return as_long(F.col(name))


def flow_duration(ts: Column, first: Column, now: Column) -> Column:
    """Seconds between the first and last packet (whole numbers); 1 when the clock ran backwards."""
    end = F.coalesce(ts, now)
    span = end - F.coalesce(first, end)
    return F.when(span < 0, F.lit(1)).otherwise(span).cast("bigint")


def _ladder(c: Column, steps: list[tuple[int, str]], top: str, at_zero: str) -> Column:
    out = F.when(c == 0, at_zero)
    for limit, label in steps:
        out = out.when(c <= limit, label)
    return out.when(c.isNotNull(), top)


def rssi_label(rssi: Column, top: str = RSSI_TOP) -> Column:
    return _ladder(rssi, RSSI_LABELS, top, "unknown")


def client_profile(rssi: Column) -> Column:
    return _ladder(rssi, PROFILE_LIMITS, PROFILE_DEFAULT, PROFILE_DEFAULT)


def strongest_ap(aps: Column, rssis: Column) -> Column:
    """``struct<ap, rssi>`` of the loudest reading; the first one on a tie."""
    top = F.array_max(rssis)
    place = F.array_position(rssis, top).cast("int") - 1
    return F.struct(F.get(aps, place).alias("ap"), top.alias("rssi"))


def zone_path(path: Column, levels: int = 4) -> Column:
    """``A>B>C>D`` to ``struct<campus, building, floor[, zone]>``; missing parts are NULL.

    Trailing empty parts count as missing.
    """
    parts = F.split(F.regexp_replace(path, ">+$", ""), ">")
    names = ["campus", "building", "floor", "zone"][:levels]
    return F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def round5(x: Column) -> Column:
    """Five decimals with ties toward positive infinity (differs from ``round`` below zero)."""
    return F.floor(x.cast("double") * 100000 + 0.5).cast("double") / 100000


def latlng(lat: Column, lon: Column) -> Column:
    """``"lat,lon"`` rounded to five decimals, NULL when either part is missing."""
    return F.concat(round5(lat).cast("string"), F.lit(","), round5(lon).cast("string"))


def status_name(code: Column) -> Column:
    """Name of a status code, NULL for codes outside the table."""
    table = F.create_map(*[F.lit(v) for pair in STATUS_NAMES.items() for v in pair])
    return F.try_element_at(table, code.cast("int"))


def as_name(info: Column) -> Column:
    """``"AS123 Some Name"`` to ``"Some Name"``; a single token is kept."""
    return F.coalesce(F.get(F.split(info, " ", 2), F.lit(1)), info)


def iso_seconds(text: Column) -> Column:
    """ISO-8601 text with a zone offset to epoch seconds; NULL when it cannot be read."""
    colon = F.regexp_replace(text, r"([+-]\d\d)(\d\d)$", "$1:$2")
    return F.unix_timestamp(F.when(text.rlike(r"^\d{4}-\d\d"), colon.try_cast("timestamp")))
