"""Dimension lookups and the merge rules that decide which side's value is kept.

None of the joins carries a broadcast hint. Spark broadcasts a dimension only when its known size is
under ``spark.sql.autoBroadcastJoinThreshold`` (checked again at run time by adaptive execution);
anything larger becomes a shuffle join whose hot partitions adaptive skew handling splits. Dimensions
hold one row per key, so a lookup never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import address

Enricher = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class StoreSpec:
    """One lookup step. ``table`` has the key columns plus payload columns, one row per key.

    ``overwrite`` lets the table's value replace the record's. ``guard_namespace`` is for site tables:
    fall back to the first key alone, and ignore a hit from another namespace.
    """

    name: str
    table: DataFrame = field(repr=False)
    keys: Sequence[str] = ("client_mac", "namespace_uuid")
    overwrite: bool = True
    guard_namespace: bool = False


@dataclass(frozen=True)
class LearnedStore:
    """One step of a chain that merges client state learned from the topics themselves.

    The state's payload stands in a struct column ``name`` of the record (see :func:`flowloom.operators.asof.asof_lookup`);
    it is merged at this place of the chain and the column goes.
    """

    name: str
    overwrite: bool = True

    def fields(self, df: DataFrame) -> list[str]:
        return [f.name for f in df.schema[self.name].dataType.fields] if self.name in df.columns else []


Store = StoreSpec | LearnedStore


def merge_columns(df: DataFrame, found: dict[str, Column], overwrite: bool) -> DataFrame:
    """Merge looked-up values into the record; NULL counts as absent on both sides."""
    out = {}
    for name, value in found.items():
        if name not in df.columns:
            out[name] = value
        elif overwrite:
            out[name] = F.coalesce(value, F.col(name))
        else:
            out[name] = F.coalesce(F.col(name), value)
    return df.withColumns(out) if out else df


def _attach(df: DataFrame, table: DataFrame, keys: Sequence[str], payload: Sequence[str], out: str) -> DataFrame:
    """Left join on null-safe keys; the payload arrives as one struct column ``out``."""
    some_key = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    dim = table.filter(some_key).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*payload).alias(out)
    )
    same = Column.__eq__ if len(keys) == 1 else Column.eqNullSafe
    on = reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(dim, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def lookup_chain(df: DataFrame, stores: Sequence[Store], namespace: str = "namespace_uuid") -> DataFrame:
    """Apply the stores in order; a later store sees the columns an earlier one added.

    Learned stores and tables may alternate. A learned store whose state the record lacks adds nothing.
    """
    guarded = any(isinstance(s, StoreSpec) and s.guard_namespace for s in stores)
    if guarded:
        own = F.col(namespace) if namespace in df.columns else F.lit(None)
        df = df.withColumn("_own_ns", own.cast("string"))
    for store in stores:
        if isinstance(store, LearnedStore):
            found = {f: F.col(f"`{store.name}`.`{f}`") for f in store.fields(df)}
            df = merge_columns(df, found, store.overwrite).drop(store.name)
            continue
        keys = list(store.keys)
        payload = [c for c in store.table.columns if c not in keys]
        for k in keys:
            if k not in df.columns:
                df = df.withColumn(k, F.lit(None).cast(store.table.schema[k].dataType))
        df = _attach(df, store.table, keys, payload, "_hit")
        if store.guard_namespace and len(keys) > 1:
            short = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys[1:]])
            first_only = store.table.filter(short).select(keys[0], *payload)
            df = _attach(df, first_only, keys[:1], payload, "_short")
            df = df.withColumn("_hit", F.coalesce("_hit", "_short")).drop("_short")
        if store.guard_namespace and namespace in payload:
            theirs = F.col(f"_hit.{namespace}").cast("string")
            other = F.coalesce(theirs != F.col("_own_ns"), F.lit(False))
            df = df.withColumn("_hit", F.when(~other, F.col("_hit")))
        df = merge_columns(df, {c: F.col(f"_hit.{c}") for c in payload}, store.overwrite).drop("_hit")
    return df.drop("_own_ns") if guarded else df


def _keeping(df: DataFrame, names: Sequence[str], change: Enricher) -> DataFrame:
    """Run ``change`` but let the record's earlier non-null values of ``names`` win."""
    kept = df.withColumns({f"_own_{n}": F.col(n) for n in names}) if names else df
    out = change(kept)
    if names:
        out = out.withColumns({n: F.coalesce(F.col(f"_own_{n}"), F.col(n)) for n in names})
    return out.drop(*[f"_own_{n}" for n in names])


def enrich_record(df: DataFrame, stores: Sequence[Store] = (), enrichers: Sequence[Enricher] = (),
                  own_wins: bool = False) -> DataFrame:
    """Store lookups, then (optionally) the record's own fields on top, then the enrichers."""
    if stores:
        payload = {c for s in stores for c in (s.fields(df) if isinstance(s, LearnedStore) else s.table.columns) if isinstance(s, LearnedStore) or c not in s.keys}
        own = [c for c in df.columns if c in payload] if own_wins else []
        df = _keeping(df, own, lambda d: lookup_chain(d, stores))
    return enrich_chain(df, enrichers)


def enrich_chain(df: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """Compose enrichers, each of which was written against the original record.

    Only the last enricher may change a column that already had a value; an earlier one can fill
    gaps and add columns. An enricher flagged ``edits_record`` (MAC scrambling) always takes effect.
    """
    for i, enrich in enumerate(enrichers):
        last = i == len(enrichers) - 1
        if last or getattr(enrich, "edits_record", False):
            df = enrich(df)
        else:
            fills = getattr(enrich, "fills", df.columns)
            df = _keeping(df, [c for c in df.columns if c in fills], enrich)
    return df


def vendor_lookup(df: DataFrame, vendors: DataFrame, mac: str = "client_mac") -> DataFrame:
    """Add ``client_mac_vendor`` from an ``(oui, vendor)`` table; a miss keeps the old value.

    Of several rows for one prefix the largest name is taken, so that no record is doubled.
    """
    if mac not in df.columns:
        return df
    dim = vendors.groupBy(F.col("oui").alias("_oui")).agg(F.max("vendor").alias("_vendor"))
    hit = df.withColumn("_key", address.oui(F.col(mac))).join(dim, F.col("_key") == F.col("_oui"), "left")
    return merge_columns(hit, {"client_mac_vendor": F.col("_vendor")}, True).drop("_key", "_oui", "_vendor")


def threat_lookup(df: DataFrame, threats: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Match both ends against a threat list keyed by ``ip``.

    With two hits the strictly higher ``darklist_score`` wins and a tie goes to ``dst``; a missing
    score sorts lowest. Without any hit direction and category are ``clean``. Of several entries for one address
    the highest score counts.
    """
    payload = [c for c in threats.columns if c != "ip"]
    entries = threats.filter(F.col("ip").isNotNull()).select("ip", F.struct(*payload).alias("e"))
    rank = F.coalesce(F.col("e.darklist_score").cast("double"), F.lit(float("-inf"))) if "darklist_score" in payload else F.lit(0)
    one = entries.groupBy("ip").agg(F.max_by("e", F.struct(rank, F.to_json("e"))).alias("e"))
    for name in (src, dst):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    side = lambda tag: one.select(F.col("ip").alias(f"_{tag}_ip"), F.col("e").alias(f"_{tag}"))
    df = df.join(side("src"), F.col(src) == F.col("_src_ip"), "left")
    df = df.join(side("dst"), F.col(dst) == F.col("_dst_ip"), "left")
    s, d = F.col("_src"), F.col("_dst")
    lowest = lambda c: F.coalesce(c.getField("darklist_score").cast("double"), F.lit(float("-inf")))
    src_wins = F.when(s.isNotNull() & d.isNotNull(), lowest(s) > lowest(d)).otherwise(s.isNotNull())
    df = df.withColumn("_hit", F.when(src_wins, s).otherwise(d))
    direction = (
        F.when(s.isNotNull() & d.isNotNull(), "both")
        .when(s.isNotNull(), "source").when(d.isNotNull(), "destination").otherwise("clean")
    )
    found = {c: F.col(f"_hit.{c}") for c in payload}
    df = df.withColumn("_direction", direction)
    df = merge_columns(df, found, True)
    category = F.when(F.col("_direction") == "clean", F.lit("clean"))
    df = merge_columns(df, {"darklist_direction": F.col("_direction"), "darklist_category": category}, True)
    return df.drop("_src", "_dst", "_src_ip", "_dst_ip", "_hit", "_direction")


def vendor_enricher(vendors: DataFrame) -> Enricher:
    fn = lambda df: vendor_lookup(df, vendors)
    fn.fills = ("client_mac_vendor",)
    return fn


def threat_enricher(threats: DataFrame) -> Enricher:
    fn = lambda df: threat_lookup(df, threats)
    fn.fills = tuple(c for c in threats.columns if c != "ip") + ("darklist_direction", "darklist_category")
    return fn
