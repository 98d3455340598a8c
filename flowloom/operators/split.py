"""Proportional split of a flow into clock-minute slices.

Slice boundaries, shares and the remainder have a closed form, so the operator is row-local: it needs
no shuffle, keeps no list of slices in a row and runs unchanged on a streaming DataFrame. The steps are
kept as separate small projections, which keeps the generated code under the JIT compiler's method limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import whole_number

#: slices produced from one array; a longer flow goes through several arrays
BLOCK = 1440

#: columns whose values are a slice's own; all others are the flow's in each of its slices
CHANGED = ("timestamp", "first_switched", "bytes", "pkts", "duration")


def split_flows(df: DataFrame, now: Column | str = "now", grace_min: int = 15) -> DataFrame:
    """One row per clock minute touched by ``[first_switched, timestamp]``.

    ``now`` is the arrival time in epoch seconds. Flows that reach back past the current hour (the
    previous one during its first ``grace_min`` minutes) start at that limit; flows that end in a later
    hour than they start, or more than an hour ahead, end at ``now``. Rows that ended over an hour ago
    keep their times. Rows whose byte count cannot be read are dropped. ``duration`` stays on the first
    slice only.
    """
    cols = df.columns
    now = (F.col(now) if isinstance(now, str) else now).cast("bigint")
    absent = lambda name: f"`{name}` is null" if name in cols else "true"
    df = df.select(
        "*", now.alias("_now"),
        *[whole_number(df, c).alias(n) for c, n in (
            ("timestamp", "_end"), ("first_switched", "_first"), ("bytes", "_bytes"), ("pkts", "_pkts"))])
    # times given: absent counts are 0 and unreadable ones drop the row; otherwise bytes must be readable
    df = df.filter(f"""_bytes is not null and (_pkts is not null or {absent('pkts')} or _end is null or _first is null)
        or _end is not null and _first is not null and {absent('bytes')} and (_pkts is not null or {absent('pkts')})""")

    hour = lambda t: f"(pmod({t}, 86400) - pmod({t}, 3600))"
    minute = "(pmod(_now, 3600) div 60)"
    df = df.selectExpr(
        "*", "_end is not null and _first is not null as _timed",
        f"_now - pmod(_now, 3600) + pmod(_now, 60) - if({minute} < {grace_min}, 3600, 0) as _earliest",
        f"{hour('_end')} = {hour('_now')} - 3600 and {minute} > {grace_min} or _now - _end > 3600 as _stale",
    ).selectExpr(
        "*", "if(not _stale and _first < _earliest, _earliest, _first) as _from",
    ).selectExpr(
        "*", f"_end > _now and ({hour('_end')} <> {hour('_from')} or _end - _now > 3600) as _ahead",
    ).selectExpr(
        "*", "if(_ahead, _now, _end) as _to", "if(_ahead and _now <= _from, _now, _from) as _start",
    ).selectExpr(
        # the first clock minute after the start, and the whole length
        "*", "_start - pmod(_start, 60) + 60 as _edge", "_to - _start as _span",
    ).selectExpr(
        # slices after the first one: clock minutes strictly before the end
        "*", "if(_timed and _to > _edge, (_to - _edge + 59) div 60, 0L) as _more",
    ).selectExpr(
        "*", "if(_more > 0, _edge - _start, _span) as _len_a",
        "if(_more > 0, _to - _edge - (_more - 1) * 60, 0L) as _len_z",
        "coalesce(_bytes, 0L) as _b", "coalesce(_pkts, 0L) as _p", "_timed and _span > 0 as _spread",
    )

    # trunc(total * length / span) without a product that could overflow
    share = lambda total, length: f"({total} div _span * {length} + {total} % _span * {length} div _span)"
    for t in ("_b", "_p"):
        df = df.selectExpr(
            "*",
            f"if(_spread, {share(t, '_len_a')}, {t}) as {t}_a",
            f"if(_spread and _more > 1, {share(t, '60L')}, 0L) as {t}_m",
            f"if(_spread and _more > 0, {share(t, '_len_z')}, 0L) as {t}_z",
        ).selectExpr(
            "*", f"if(_more > 0, {t}_z, {t}_a) as {t}_last", f"{t} - {t}_a - (_more - 1) * {t}_m - {t}_z as {t}_rest",
        ).selectExpr(
            # what the shares leave over goes to the last slice, unless that would not be positive
            "*", f"if(_more > 0 and {t}_last + {t}_rest > 0, {t}_last + {t}_rest, {t}_last) as {t}_fin",
        )
    keep = [f"`{c}`" for c in cols if c not in ("timestamp", "bytes", "pkts", "first_switched")]
    df = df.selectExpr(
        *keep, "_more", "if(_timed, _start, coalesce(_end, _now)) as _start", "_edge",
        "if(_timed, cast(null as bigint), _first) as _first",
        "_b_a", "_b_m", "_b_fin", "if(_timed, _p_a, _pkts) as _p_a", "_p_m", "_p_fin",
        f"explode(sequence(0L, _more div {BLOCK})) as _block",
    ).selectExpr(
        "*", f"explode(sequence(_block * {BLOCK}, least(_block * {BLOCK} + {BLOCK - 1}, _more))) as _i",
    )
    value = lambda t: f"case when _i = 0 and _more > 0 then {t}_a when _i = _more then {t}_fin else {t}_m end"
    out = {
        "timestamp": "if(_i = 0, _start, _edge + (_i - 1) * 60)",
        "bytes": value("_b"),
        "pkts": f"if(_more = 0, _p_a, {value('_p')})",
        "first_switched": "_first",
        "duration": "if(_i = 0, duration, null)",
    }
    names = list(dict.fromkeys(cols + ["timestamp", "bytes", "pkts"]))
    return df.selectExpr(*[f"{out[c]} as `{c}`" if c in out else f"`{c}`" for c in names])
