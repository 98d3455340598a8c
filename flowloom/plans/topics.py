"""Which steps a topic goes through, as a registry of DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators import counters, metrics, nmsp, records
from flowloom.operators import location as loc
from flowloom.operators.lookup import Enricher, Store, enrich_record
from flowloom.plans.states import attach_states
from flowloom.sources.topics import SEQUENCE

Step = Callable[[DataFrame, "Context"], DataFrame]

# Base datasource under which a topic's records are counted; the other topics have no counter.
COUNTED = {fields.FLOW: "rb_flow", fields.STATE: "rb_state", fields.NMSP: "rb_location", fields.LOC: "rb_location", fields.RADIUS: "rb_location"}

#: marks records that are counted but not sent on
PUBLISH = "_publish"
CLOCK = "_clock"

# Enrichers of each topic, in order.
TOPIC_ENRICHERS = {
    fields.FLOW: ["mac_vendor", "geo_ip", "mac_hashing"],
    fields.EVENT: ["mac_vendor", "geo_ip", "mac_hashing"],
    fields.NMSP: ["mac_hashing"],
    fields.RADIUS: ["mac_vendor", "mac_hashing"],
}


@dataclass
class Context:
    """Tables and settings a topic's steps may use.

    ``stores`` is the chain of lookups in its configured order: tables (``StoreSpec``) and client states learned from the
    topics (``LearnedStore``), whose history is given in ``states`` (see :func:`flowloom.plans.states.learned_states`).
    ``enrichers`` maps a name to an enricher; a topic uses those of :data:`TOPIC_ENRICHERS` that are
    present. ``now`` is a Column for the processing time (default: the record's ``arrival``).
    """

    stores: Sequence[Store] = ()
    states: Sequence[DataFrame] = ()
    enrichers: dict[str, Enricher] = field(default_factory=dict)
    topic_enrichers: dict[str, list[str]] = field(default_factory=lambda: dict(TOPIC_ENRICHERS))
    now: object = None
    rssi_limit: int = nmsp.RSSI_LIMIT
    class_filter: str = ""
    sticky: bool = True

    def chain(self, topic: str) -> list[Enricher]:
        return [self.enrichers[n] for n in self.topic_enrichers.get(topic, []) if n in self.enrichers]

    def known(self, df: DataFrame) -> DataFrame:
        """Records with the learned states that the chain will merge."""
        wanted = {s.name for s in self.stores}
        found = attach_states(df, self.states)
        return found.drop(*[n for d in self.states for n in d.columns if n not in df.columns and n not in wanted])


def _flow(df: DataFrame, c: Context) -> DataFrame:
    return records.flow(c.known(df), c.stores, c.chain(fields.FLOW), nmsp.arrival(df, c.now))


def _event(df: DataFrame, c: Context) -> DataFrame:
    return records.event(c.known(df), c.stores, c.chain(fields.EVENT))


def _state(df: DataFrame, c: Context) -> DataFrame:
    return records.ap_state(df, c.stores)


def _nmsp(df: DataFrame, c: Context) -> DataFrame:
    info = nmsp.nmsp_info(df, c.now)
    measures = nmsp.judge_measures(nmsp.pair_with_info(df, nmsp.info_state(info), c.now), c.rssi_limit).drop("_stale")
    rows = measures.unionByName(info.withColumn(PUBLISH, F.lit(True)), allowMissingColumns=True)
    return enrich_record(c.known(rows), c.stores, c.chain(fields.NMSP), own_wins=True)


def _loc(df: DataFrame, c: Context) -> DataFrame:
    old = loc.location_v89(df.filter("StreamingNotification is not null"), c.now)
    new = df.filter("StreamingNotification is null and notifications is not null")
    followed = loc.follow_clients(loc.notifications(new, c.now), loc.v89_state(old), c.sticky)
    chain = c.chain(fields.LOC)
    # store policy decides for version 8/9, the record's own fields win for version 10
    return enrich_record(c.known(old), c.stores, chain).unionByName(
        enrich_record(c.known(loc.shape_v10(followed)), c.stores, chain, own_wins=True), allowMissingColumns=True)


def _radius(df: DataFrame, c: Context) -> DataFrame:
    rows = records.radius_output(records.radius(df, c.now))
    return enrich_record(c.known(rows), c.stores, c.chain(fields.RADIUS), own_wins=True)


def _metrics(df: DataFrame, c: Context) -> DataFrame:
    return metrics.flatten_job_metrics(df, c.class_filter)


REGISTRY: dict[str, list[Step]] = {
    fields.FLOW: [_flow],
    fields.EVENT: [_event],
    fields.STATE: [_state],
    fields.NMSP: [_nmsp],
    fields.LOC: [_loc],
    fields.RADIUS: [_radius],
    fields.METRICS: [_metrics],
}


def register(topic: str, *steps: Step, append: bool = False) -> None:
    """Set (or with ``append`` extend) the steps of a topic."""
    REGISTRY[topic] = [*(REGISTRY.get(topic, []) if append else []), *steps]


class Outputs(list):
    """The record frames of a topic's steps; with windows also ``counts`` (datasource, window_start, events) and ``monitor`` rows."""

    counts: DataFrame | None = None
    monitor: DataFrame | None = None


def run_steps(df: DataFrame, topic: str, context: Context | None = None) -> list[DataFrame]:
    """The steps' frames as they are, with records that are only counted (:data:`PUBLISH` false) and the clock column, where kept."""
    if topic not in REGISTRY:
        raise KeyError(f"no steps registered for topic {topic!r}")
    context = context or Context()
    wanted = set(context.topic_enrichers.get(topic, [])) if context.enrichers else set()
    missing = wanted - set(context.enrichers)
    if missing:
        raise KeyError(f"enrichers not supplied for {topic!r}: {sorted(missing)}")
    if SEQUENCE not in df.columns:
        df = df.withColumn(SEQUENCE, F.monotonically_increasing_id())
    return [step(df, context) for step in REGISTRY[topic]]


def run_topic(df: DataFrame, topic: str, context: Context | None = None, window_seconds: int | None = None) -> Outputs:
    """Outputs of the topic's steps, each of which reads the topic itself.

    An unknown topic, or an enricher name that nobody supplied, raises here rather than at run time. Rows without a
    sequence column (see :func:`flowloom.sources.topics.read_topic`) are numbered in file order.

    With ``window_seconds`` the records of a counted topic (:data:`COUNTED`) get ``flows_count``, what their datasource counted in the
    window before, and the result has the counts and their monitor rows. Windows follow the processing time of a flow or state record,
    else the record's own time; a flow counts once per slice. In batch the counts are a second pass over the steps;
    a stream computes records once per micro-batch (:func:`flowloom.streaming.topics.topic_sink`).
    """
    if window_seconds is not None and topic in COUNTED:
        df = with_clock(df, context)
    frames = run_steps(df, topic, context)
    if window_seconds is None or topic not in COUNTED:
        return Outputs(published(f).drop(CLOCK) for f in frames)
    named = [name_and_clock(f, topic) for f in frames]
    counts = count_frames(named, window_seconds)
    out = Outputs(counters.with_prev_window_count(published(f), counts, window_seconds, CLOCK).drop("datasource", CLOCK) for f in named)
    out.counts, out.monitor = counts, counters.monitor_rows(counts, window_seconds)
    return out


def published(df: DataFrame) -> DataFrame:
    return df.filter(F.col(PUBLISH)).drop(PUBLISH) if PUBLISH in df.columns else df


def with_clock(df: DataFrame, context: Context | None) -> DataFrame:
    timed = df if "timestamp" in df.columns or "arrival" in df.columns else None
    now = context.now if context else None
    return df.withColumn(CLOCK, nmsp.arrival(df, now).cast("bigint")) if timed is not None or now is not None else df


def name_and_clock(df: DataFrame, topic: str) -> DataFrame:
    """Records with the datasource that counts them and the time by which they are counted."""
    namespace = F.col("namespace_uuid") if "namespace_uuid" in df.columns else F.lit(None).cast("string")
    at = F.col(CLOCK) if CLOCK in df.columns else F.col("timestamp").cast("bigint")
    return df.withColumns({"datasource": counters.datasource_name(COUNTED[topic], namespace), CLOCK: at})


def count_frames(named: Sequence[DataFrame], seconds: int) -> DataFrame:
    """Counts per datasource and window over all frames of :func:`name_and_clock`."""
    each = [counters.datasource_counts(f.filter(F.col(CLOCK).isNotNull()), seconds, CLOCK) for f in named]
    if len(each) == 1:
        return each[0]
    return reduce(DataFrame.unionByName, each).groupBy("datasource", "window_start").agg(F.sum("events").alias("events"))


def meraki_step(df: DataFrame, c: Context) -> DataFrame:
    """Cloud-controller topic, for :func:`register`; it is not wired by default."""
    return enrich_record(loc.meraki(df), c.stores, (), own_wins=True)


def guest_step(df: DataFrame, c: Context) -> DataFrame:
    """Guest-profile topic, for :func:`register`; yields state, not output."""
    return records.guest_profiles(enrich_record(df, c.stores))
