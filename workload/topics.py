"""Counters of the topic plans: flows_count on records and monitor rows, in batch and over micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators import records
from flowloom.plans.topics import Outputs, run_topic
from flowloom.streaming.tables import asof_sink
from flowloom.streaming.topics import read_outputs, run_stream
from flowloom.streaming.wiring import shared_folder
from workload.catalog import query
from workload.clients import JUDGED
from workload.ingest import ALL_SEEN, STATE_COLUMNS, chain, learned
from workload.scalar import SLICES, SRC_PLAIN
from workload.views import oracle, view

WINDOW = 60
DATASOURCE = "case when namespace_uuid is null then '{0}' else '{0}_' || namespace_uuid end"

SLICED = SRC_PLAIN + "," + SLICES + f""",
 sliced as (select s.event_id, s.st, {DATASOURCE.format('rb_flow').replace('namespace_uuid', 'f.namespace_uuid')} as datasource, f.arrival - f.arrival % {WINDOW} as ws from slices s join fx_flow f on f.event_id = s.event_id),
 flow_counts as (select datasource, ws, count(*) as n from sliced group by 1, 2)"""
FLOW_COUNTS = """
select s.event_id, s.st as "timestamp", case when s.ws > a.first_ws then coalesce(c.n, 0) end as flows_count
from sliced s join (select datasource, min(ws) as first_ws from flow_counts group by 1) a on a.datasource = s.datasource
left join flow_counts c on c.datasource = s.datasource and c.ws = s.ws - 60"""
MONITOR = """
select ws + 60 as "timestamp", 'enrichmentstreamtask' as type, 'enrichmentstreamtask_messages' as monitor, 'task-0-0-' || datasource as sensor_name, n as value,
  case when len(string_split(datasource, '_')) >= 3 then string_split(datasource, '_')[-1] end as namespace_uuid from {}"""
# weak readings are counted though they are not sent on; readings of an AP that the association does not name are not
CLIENT_COUNTS = f"""client_counts as (select {DATASOURCE.format('rb_location')} as datasource, "timestamp" - "timestamp" % {WINDOW} as ws, count(*) as n
 from (select namespace_uuid, "timestamp" from judged union all select namespace_uuid, "timestamp" from info) t group by 1, 2)"""


def of_flows(out: Outputs) -> DataFrame:
    return out[0].select("event_id", "timestamp", "flows_count")


@query("topic_flow_counts", oracle(FLOW_COUNTS, SLICED))
def topic_flow_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What each slice's datasource counted in the minute before the flow arrived."""
    return of_flows(run_topic(view(spark, sf, "fx_flow"), fields.FLOW, window_seconds=WINDOW))


@query("topic_monitor_rows", oracle(f"{MONITOR.format('flow_counts')} union all {MONITOR.format('client_counts')}", f"{SLICED},{JUDGED.strip()},{CLIENT_COUNTS}"))
def topic_monitor_rows(spark: SparkSession, sf: str) -> DataFrame:
    flows = run_topic(view(spark, sf, "fx_flow"), fields.FLOW, window_seconds=WINDOW)
    return flows.monitor.unionByName(run_topic(view(spark, sf, "fx_nmsp"), fields.NMSP, window_seconds=WINDOW).monitor)


def in_parts(spark: SparkSession, df: DataFrame, by: str, folder: str, parts: int = 3) -> Iterator[DataFrame]:
    """``df`` as a stream of files that grows part by part, in order of ``by`` (epoch seconds) and cut between minutes."""
    minute = F.floor(F.col(by) / WINDOW)
    cuts = [None, *df.agg(F.percentile_approx(minute, [i / parts for i in range(1, parts)])).first()[0], None]
    for low, high in zip(cuts, cuts[1:]):
        part = df if low is None else df.filter(minute > low)
        (part if high is None else part.filter(minute <= high)).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(df.schema).parquet(f"{folder}/in")


def streamed_flows(spark: SparkSession, sf: str) -> tuple[str, Outputs]:
    """The flow topic in order of arrival, in three runs of which each resumes from the checkpoint of the one before."""
    folder = f"{shared_folder(spark)}/topic-{uuid.uuid4().hex}"
    for stream in in_parts(spark, view(spark, sf, "fx_flow"), "arrival", folder):
        run_stream(stream, folder, fields.FLOW, seconds=WINDOW)
    return folder, read_outputs(spark, folder, closing=True, seconds=WINDOW)


@query("stream_topic_flow_counts", oracle(FLOW_COUNTS, SLICED))
def stream_topic_flow_counts(spark: SparkSession, sf: str) -> DataFrame:
    return of_flows(streamed_flows(spark, sf)[1])


@query("stream_topic_monitor_rows", oracle(MONITOR.format("flow_counts"), SLICED))
def stream_topic_monitor_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each window's row once, the last ones by closing the ended stream."""
    return streamed_flows(spark, sf)[1].monitor


# ---------------------------------------------------------------- all learned states over micro-batches

@query("stream_flow_all_states", oracle("""
select s.event_id, s.st as "timestamp", s.bytes, client_rssi_num, wireless_station, wireless_id, dot11_status, campus, building, client_id, client_fullname
from slices s join every_state e on e.event_id = s.event_id""", SRC_PLAIN + "," + SLICES + "," + ALL_SEEN))
def stream_flow_all_states(spark: SparkSession, sf: str) -> DataFrame:
    """Flows and the six feeds that leave client state, as one stream in three runs; state stays in hash buckets between micro-batches."""
    flows, signals = view(spark, sf, "fx_flow"), view(spark, sf, "fx_nmsp")
    own = [c for c in signals.columns if c not in flows.columns]
    both = flows.withColumn("feed", F.lit("flow")).unionByName(signals.withColumn("feed", F.lit("nmsp")), allowMissingColumns=True)
    folder = f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"
    stores = chain(spark)

    def split(batch: DataFrame, known: dict[str, DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
        probes = batch.filter("feed = 'flow'").drop("feed", *own)
        return probes, learned(probes, batch.filter("feed = 'nmsp'").select(*signals.columns), known)

    def finish(found: DataFrame) -> DataFrame:
        return records.flow(found, stores, now="arrival").select("event_id", "timestamp", "bytes", *STATE_COLUMNS)

    for stream in in_parts(spark, both, "timestamp", folder):
        sink = stream.writeStream.foreachBatch(asof_sink(folder, split, finish)).option("checkpointLocation", f"{folder}/checkpoint")
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")
