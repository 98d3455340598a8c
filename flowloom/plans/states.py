"""Client state learned from the topics, as frames that every topic's records can be joined to in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators import location, nmsp, records
from flowloom.operators.asof import HOT_ROWS, asof_lookup, state_columns

PLACE = ["client_mac", "namespace_uuid", "timestamp", "event_id"]


def as_state(rows: DataFrame, name: str) -> DataFrame:
    """State rows (key, time, sequence, payload) with the payload as the struct column ``name``."""
    payload = [c for c in rows.columns if c not in PLACE]
    return rows.select(*PLACE, *state_columns(rows, {name: payload}).values())


def location_state(rows: DataFrame) -> DataFrame:
    """Location state with all its fields, whichever feed left it."""
    own = [(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in location.STATE_FIELDS]
    return as_state(rows.select(*PLACE, *own), "location")


def learned_states(nmsp_rows: DataFrame | None = None, location_rows: DataFrame | None = None, meraki_rows: DataFrame | None = None,
                   radius_rows: DataFrame | None = None, guest_rows: DataFrame | None = None, now: Column | None = None,
                   sticky: bool = True, carried: dict[str, DataFrame] | None = None) -> list[DataFrame]:
    """``shared`` frames of :func:`flowloom.operators.asof.asof_lookup` from the topics' parsed records.

    Names: ``nmsp-measure``, ``nmsp-info``, ``location`` (all three location feeds), ``radius`` and ``pms``. ``carried`` holds, by name,
    the latest states of earlier micro-batches, which new records of their clients are judged by; they are not part of the result.
    """
    out: list[DataFrame] = []
    carried = carried or {}
    if nmsp_rows is not None:
        info = nmsp.info_state(nmsp.nmsp_info(nmsp_rows, now))
        known = info if "nmsp-info" not in carried else info.unionByName(_unpacked(carried["nmsp-info"], "nmsp-info"), allowMissingColumns=True)
        out += nmsp.client_history(info, nmsp.judge_measures(nmsp.pair_with_info(nmsp_rows, known, now)))
    resets = location.meraki_state(location.meraki(meraki_rows)) if meraki_rows is not None else None
    if location_rows is not None:
        old = location.v89_state(location.location_v89(location_rows.filter("StreamingNotification is not null"), now))
        resets = old if resets is None else old.unionByName(resets, allowMissingColumns=True)
        if "notifications" in location_rows.columns:
            new = location_rows.filter("StreamingNotification is null and notifications is not null")
            # what earlier batches left is where the client's record starts from, just as after a reset
            start = resets if "location" not in carried else resets.unionByName(_unpacked(carried["location"], "location"), allowMissingColumns=True)
            followed = location.follow_clients(location.notifications(new, now), start, sticky)
            out.append(location_state(location.v10_state(followed)))
    if resets is not None:
        out.append(location_state(resets))
    if radius_rows is not None:
        out.append(as_state(records.radius_state(records.radius(radius_rows, now)), "radius"))
    if guest_rows is not None:
        out.append(as_state(records.guest_profiles(guest_rows), "pms"))
    return out


def _unpacked(state: DataFrame, name: str) -> DataFrame:
    """State rows with their payload as columns; removed states are left out."""
    fields = [f.name for f in state.schema[name].dataType if f.name != "_gone"]
    return state.filter(~F.col(f"`{name}`._gone")).select(*PLACE, *[F.col(f"`{name}`.`{f}`").alias(f) for f in fields])


def attach_states(df: DataFrame, states: Sequence[DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Records with one struct column per learned state, as of their own time; see ``LearnedStore``."""
    return asof_lookup(df, {}, shared=states, hot_rows=hot_rows, count_on=[df]) if states else df
