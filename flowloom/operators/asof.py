"""Latest-known-state columns ("as of" enrichment) that survive a hot key.

Rows of one key are put in time order by a running window. A plain window per client would send every row
of a busy client (a NAT gateway, a default MAC) to one task, so keys with more than :data:`HOT_ROWS` rows
are found first and their order axis is cut into chunks: a second and a block of tie-breakers. Only rows of
one chunk meet in a window; what earlier chunks hand over is worked out on one row per chunk, hour by hour.
Every window is therefore bounded whatever share of the data one key holds, and ordinary keys cost a single
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowloom.operators.lookup import merge_columns

#: rows of one key that a single window may hold
HOT_ROWS = 2_000_000
TIE_BLOCK = 1 << 20
HOUR = 3600


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null forms of the keys, so that grouping and joining share one partitioning."""
    own = lambda k: F.col(k) if k in df.columns else F.lit(None)
    return df.withColumns({n: F.coalesce(F.concat(F.lit("="), own(k).cast("string")), F.lit(""))
                           for n, k in zip(_key_names(keys), keys)})


def cut_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], block_on: str | None = None,
               hot_rows: int = HOT_ROWS, tie_block: int = TIE_BLOCK,
               count_on: Sequence[DataFrame] | None = None) -> tuple[DataFrame, list[str]]:
    """Add chunk columns to ``df``; also gives their names.

    ``order`` starts with an epoch-seconds column; ``block_on`` (its last column unless named) is the
    integer tie-breaker that tells rows of one second apart. Hot keys are counted on ``count_on`` when
    given (cheaper inputs with the same keys), else on ``df``; the choice affects speed only. The hot
    keys are broadcast: there are at most ``rows / hot_rows`` of them.
    """
    names = _key_names(keys)
    df = _with_keys(df, keys)
    counted = [_with_keys(d, keys).groupBy(*names).count() for d in count_on] if count_on else [df.groupBy(*names).count()]
    total = reduce(DataFrame.unionByName, counted)
    if len(counted) > 1:
        total = total.groupBy(*names).agg(F.sum("count").alias("count"))
    hot = total.filter(F.col("count") > hot_rows).select(*names, F.lit(True).alias("_hot"))
    df = df.join(F.broadcast(hot), names, "left")

    block_on = block_on or order[-1]
    exact = list(order[:list(order).index(block_on)])
    # the flag is part of the chunk, so a filter on it reaches the inputs of earlier windows
    df = df.withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    only_hot = lambda c: F.coalesce(F.when(F.col("_hot"), c.cast("bigint")), F.lit(-1).cast("bigint"))
    marks = {"_hour": only_hot(F.floor(F.col(order[0]) / HOUR))}
    marks |= {f"_x{i}": only_hot(F.col(c)) for i, c in enumerate(exact)}
    marks["_blk"] = only_hot(F.floor(F.col(block_on) / tie_block))
    return df.withColumns(marks), [*names, "_hot", *marks]


def _handed_over(hot: DataFrame, chunk: Sequence[str], order: Sequence[str], states: Sequence[str],
                 group: Sequence[str], first: bool) -> DataFrame:
    """Per chunk (and group) of the hot keys: what earlier chunks say about each state, as ``_s<i>``."""
    keys, place = list(chunk[:list(chunk).index("_hour")]), list(chunk[list(chunk).index("_hour") + 1:])
    best, pick = (F.min_by, F.first) if first else (F.max_by, F.last)
    known = lambda s, by: best(F.col(s), F.when(F.col(s).isNotNull(), by)).alias(s)
    before = lambda *by: Window.partitionBy(*by, *group).rowsBetween(Window.unboundedPreceding, -1)
    handed = lambda w, tag: [pick(s, ignorenulls=True).over(w).alias(f"{tag}{i}") for i, s in enumerate(states)]
    fine = hot.groupBy(*chunk, *group).agg(*[known(s, F.struct(*order)) for s in states])
    coarse = fine.groupBy(*keys, "_hour", *group).agg(*[known(s, F.struct(*place)) for s in states])
    fine = fine.select(*chunk, *group, *handed(before(*keys, "_hour").orderBy(*place), "_f"))
    coarse = coarse.select(*keys, "_hour", *group, *handed(before(*keys).orderBy("_hour"), "_c"))
    near, far = ("_c", "_f") if first else ("_f", "_c")
    return fine.join(coarse, [*keys, "_hour", *group], "left").select(
        *chunk, *group, *[F.coalesce(f"{near}{i}", f"{far}{i}").alias(f"_s{i}") for i in range(len(states))])


def fill_last(df: DataFrame, chunk: Sequence[str], order: Sequence[str], states: Sequence[str]) -> DataFrame:
    """Replace each column of ``states`` by its latest non-null value up to and including the row, per key.

    ``df`` and ``chunk`` come from :func:`cut_chunks`; the result keeps its partitioning.
    """
    upto = Window.partitionBy(*chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({s: F.last(s, ignorenulls=True).over(upto) for s in states})
    carry = _handed_over(df.filter("_hot"), chunk, order, states, [], first=False)
    filled = {s: F.coalesce(F.col(f"`{s}`"), F.col(f"_s{i}")).alias(s) for i, s in enumerate(states)}
    return local.join(carry, list(chunk), "left").select(*[filled.get(c, F.col(f"`{c}`")) for c in df.columns])


def fill_group(df: DataFrame, chunk: Sequence[str], order: Sequence[str], states: Sequence[str], group: str,
               first: bool) -> DataFrame:
    """Like :func:`fill_last`, within runs of rows that share ``group``.

    ``group`` is a non-null column that grows along the order. With ``first`` a state keeps the first
    value of its run instead of taking the latest.
    """
    window = Window.partitionBy(*chunk, group).orderBy(*order)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pick = F.first if first else F.last
    local = df.withColumns({s: pick(s, ignorenulls=True).over(upto) for s in states})
    carry = _handed_over(df.filter("_hot"), chunk, order, states, [group], first)
    # only the run a chunk starts with can have begun earlier: one row per chunk is enough
    parts = [f"_s{i}" for i in range(len(states))]
    carry = carry.groupBy(*chunk).agg(F.min_by(F.struct(F.col(group).alias("_g"), *parts), F.col(group)).alias("_in"))
    came = lambda i: F.when(F.col(group) == F.col("_in._g"), F.col(f"_in._s{i}"))
    filled = {
        s: F.coalesce(*((came(i), F.col(f"`{s}`")) if first else (F.col(f"`{s}`"), came(i)))).alias(s)
        for i, s in enumerate(states)}
    return local.join(carry, list(chunk), "left").select(*[filled.get(c, F.col(f"`{c}`")) for c in df.columns])


def running_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], states: Sequence[str],
                 block_on: str | None = None, hot_rows: int = HOT_ROWS, tie_block: int = TIE_BLOCK,
                 count_on: Sequence[DataFrame] | None = None) -> DataFrame:
    """:func:`cut_chunks` and :func:`fill_last` in one step."""
    marked, chunk = cut_chunks(df, keys, order, block_on, hot_rows, tie_block, count_on)
    return fill_last(marked, chunk, order, states).drop(*chunk)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of every key as a partial aggregate (no per-key sort)."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return top.select(*keys, "_row.*")


def state_columns(df: DataFrame, payloads: dict[str, Sequence[str]], removed: dict[str, Column] | None = None) -> dict[str, Column]:
    """Struct columns for :func:`asof_lookup`: per state name its payload columns and a removal flag."""
    removed = removed or {}
    return {n: F.struct(removed.get(n, F.lit(False)).alias("_gone"), *cols).alias(n) for n, cols in payloads.items()}


def asof_lookup(
    probes: DataFrame,
    states: dict[str, DataFrame],
    keys: Sequence[str] = ("client_mac", "namespace_uuid"),
    ts: str = "timestamp",
    seq: str = "event_id",
    shared: Sequence[DataFrame] = (),
    hot_rows: int = HOT_ROWS,
    count_on: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Attach to every probe row, per named state, the payload in force at its time.

    A state table has ``keys``, ``ts``, ``seq`` and payload columns; an optional boolean ``deleted``
    column marks removals. ``shared`` tables instead carry ready :func:`state_columns`, so that one pass
    over a table can feed several states. A state at the same second as a probe is visible to it. The
    result has one struct column per state, NULL when nothing is known or the state was removed. Rows
    whose first key is NULL neither leave nor see state.
    """
    keys, fixed = list(keys), {*keys, ts, seq, "deleted"}
    frames: list[DataFrame] = []
    for name, d in states.items():
        gone = {name: F.coalesce(F.col("deleted"), F.lit(False))} if "deleted" in d.columns else None
        own = state_columns(d, {name: [c for c in d.columns if c not in fixed]}, gone)
        frames.append(d.select(*[c for c in (*keys, ts, seq) if c in d.columns], *own.values()))
    frames += list(shared)
    typed = {f.name: f.dataType for d in frames for f in d.schema if f.name not in fixed}
    names = list(typed)
    nothing = {n: F.lit(None).cast(StructType([f for f in t if f.name != "_gone"])) for n, t in typed.items()}
    if keys[0] not in probes.columns:
        return probes.withColumns(nothing)
    probe_cols = [c for c in probes.columns if c not in (*keys, ts, seq)]
    probe_type = probes.select(F.struct(*probe_cols).alias("p")).schema["p"].dataType

    def position(d: DataFrame, ts_name: str, seq_name: str) -> list[Column]:
        own = lambda k: F.col(k) if k in d.columns else F.lit(None)
        return [own(k).cast("string").alias(k) for k in keys] + [
            F.col(ts).cast("bigint").alias(ts_name), F.col(seq).cast("bigint").alias(seq_name)]

    def tagged(d: DataFrame, rank: int, probe: bool = False) -> DataFrame:
        own = lambda n: F.col(f"`{n}`") if n in d.columns and not probe else F.lit(None).cast(typed[n])
        body = F.struct(*probe_cols) if probe else F.lit(None).cast(probe_type)
        return d.filter(F.col(keys[0]).isNotNull()).select(
            *position(d, "_ts", "_seq"), F.lit(rank).alias("_rank"), *[own(n).alias(n) for n in names], body.alias("_probe"))

    parts = [tagged(d, i) for i, d in enumerate(frames)] + [tagged(probes, len(frames), probe=True)]
    union = reduce(DataFrame.unionByName, parts)
    filled = running_last(union, keys, ["_ts", "_rank", "_seq"], names, hot_rows=hot_rows, count_on=count_on)
    live = lambda n: F.when(~F.col(f"`{n}`._gone"), F.struct(*[
        F.col(f"`{n}`.`{f.name}`").alias(f.name) for f in typed[n] if f.name != "_gone"])).alias(n)
    hits = filled.filter(F.col("_probe").isNotNull()).select(
        *keys, F.col("_ts").alias(ts), F.col("_seq").alias(seq), "_probe.*", *[live(n) for n in names])
    unkeyed = probes.filter(F.col(keys[0]).isNull()).select(*position(probes, ts, seq), *probe_cols)
    return hits.unionByName(unkeyed.withColumns(nothing))


def merge_states(df: DataFrame, policies: dict[str, bool]) -> DataFrame:
    """Merge the struct columns of :func:`asof_lookup` into the record, in order.

    ``policies`` maps a state name to its overwrite flag.
    """
    for name, overwrite in policies.items():
        fields = [f.name for f in df.schema[name].dataType]
        df = merge_columns(df, {f: F.col(f"`{name}`.`{f}`") for f in fields}, overwrite)
    return df.drop(*policies)
