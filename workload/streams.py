"""Streaming queries: each runs its source to the end and returns the table it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import records, rollup
from flowloom.operators.counters import datasource_name
from flowloom.streaming import clients, windows
from flowloom.streaming.wiring import ROCKSDB, run_available, shared_folder
from workload.catalog import query
from workload.clients import JUDGED, RADIO, as_notification, followed_sql, with_radio
from workload.near import compare
from workload.scalar import FLOW_SMALL, LABEL, PROFILE, SLICES, SRC_PLAIN
from workload.views import VIEWS, oracle, view
from workload.windows import CAPACITY, NAMED, PREV_SQL, hourly_load


def stream_view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A view over the events table read as a stream of files."""
    schema = view(spark, sf, "events").schema
    spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*").createOrReplaceTempView("events")
    return spark.sql(VIEWS[name])


def named(flows: DataFrame) -> DataFrame:
    return flows.withColumn("datasource", datasource_name("rb_flow", F.col("namespace_uuid")))


@query("stream_flow_rollup", oracle("""
select st - st % 60 as "timestamp", case when namespace_uuid is null then 'rb_flow' else 'rb_flow_' || namespace_uuid end as datasource,
  application_id_name, count(*) as events, cast(sum(bytes) as bigint) as sum_bytes, cast(sum(pkts) as bigint) as sum_pkts, cast(0 as bigint) as sum_rssi,
  count(distinct client_mac) as clients, cast(0 as bigint) as wireless_stations, true as clients_near, true as wireless_stations_near
from slices group by all""", SRC_PLAIN + "," + SLICES))
def stream_flow_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The whole stream: windows closed by the watermark and, its source having ended, those left open."""
    flows, rows = (named(records.flow(df, now="arrival")) for df in (stream_view(spark, sf, "fx_flow"), view(spark, sf, "fx_flow")))
    found = windows.rollup_to_end(flows, rows, FLOW_SMALL, extra_dims=("datasource",), name="flow-rollup")
    sketches = ["clients", "wireless_stations"]
    dims = ["timestamp", "datasource", "application_id_name"]
    exact = rollup.rollup(rows, FLOW_SMALL, "exact", extra_dims=("datasource",)).select(*dims, *sketches)
    near = compare(exact, found.withColumns({c: F.hll_sketch_estimate(c) for c in sketches}), dims, sketches)
    sums = found.drop(*sketches).withColumnsRenamed({d: f"o_{d}" for d in dims})
    return sums.join(near, [F.col(f"o_{d}").eqNullSafe(F.col(d)) for d in dims]).drop(*[f"o_{d}" for d in dims])


@query("stream_nmsp_measure", oracle(f"""
select event_id, "timestamp", client_mac, namespace_uuid, client_rssi_num, wireless_station, wireless_id, lan_vlan, last_seen,
  {LABEL.format('client_rssi_num', 'excellent')} as client_rssi, {PROFILE.format('client_rssi_num')} as client_profile,
  case when joined then 'ASSOCIATED' else 'PROBING' end as dot11_status, 'nmsp-measure' as type, {RADIO} from judged where client_rssi_num >= -80 or joined""", JUDGED))
def stream_nmsp_measure(spark: SparkSession, sf: str) -> DataFrame:
    out = run_available(clients.stream_nmsp(with_radio(stream_view(spark, sf, "fx_nmsp"))), name="nmsp", provider=ROCKSDB)
    return out.filter("_publish").drop("_publish", "_stale")


@query("stream_location_v10", followed_sql("first_value"))
def stream_location_v10(spark: SparkSession, sf: str) -> DataFrame:
    rows = stream_view(spark, sf, "fx_location10").select("event_id", F.array(as_notification()).alias("notifications"))
    return run_available(clients.stream_location(rows), name="location")


@query("stream_window_counts", oracle("""
select datasource, ws as window_start, n as events from counted""", """
counted as (select case when namespace_uuid is null then 'rb_flow' else 'rb_flow_' || namespace_uuid end as datasource,
  "timestamp" - "timestamp" % 60 as ws, count(*) as n from fx_flow group by 1, 2)"""))
def stream_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return windows.window_counts_to_end(named(stream_view(spark, sf, "fx_flow")), named(view(spark, sf, "fx_flow")))


@query("stream_prev_window_count", oracle(PREV_SQL, NAMED))
def stream_prev_window_count(spark: SparkSession, sf: str) -> DataFrame:
    """The previous window's count from a table that the micro-batches keep."""
    folder = f"{shared_folder(spark)}/prev-window-{uuid.uuid4().hex}"
    flow = stream_view(spark, sf, "fx_flow").writeStream.foreachBatch(windows.prev_window_sink(folder, named))
    flow.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "datasource", "flows_count")


@query("stream_capacity_report", oracle("""
select r.datasource, r.ws as window_start, cast(current as int) as partitions, cast(greatest(l.index_replicas, 1) as int) as replicas
from runs r join limits l on l.datasource = r.datasource""", CAPACITY))
def stream_capacity_report(spark: SparkSession, sf: str) -> DataFrame:
    """A table of window counts, followed as a stream with limits per datasource."""
    counts, limits = hourly_load(spark, sf)
    folder = f"{shared_folder(spark)}/window-counts-{uuid.uuid4().hex}"
    counts.write.parquet(folder)
    feed = spark.readStream.schema(counts.schema).parquet(folder)
    out = run_available(windows.stream_capacity(feed, limits, seconds=3600, per_task=200), name="capacity")
    return out.select("datasource", "window_start", "partitions", "replicas")
