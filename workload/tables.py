"""Dimension files, pinned snapshots, expiring state, and index tables that merge late minutes."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import lookup, nmsp, ranges, rollup
from flowloom.plans.index import index_sink, read_index
from flowloom.sources import dimensions
from flowloom.sources.versioned import PinnedDimension
from flowloom.streaming.asof import stream_asof
from flowloom.streaming.wiring import ROCKSDB, run_available, shared_folder
from workload.catalog import query
from workload.clients import RUNNING
from workload.near import compare
from workload.scalar import geo_body
from workload.topics import in_parts
from workload.views import oracle, view


def folder_for(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def one_file(df: DataFrame, order: str, folder: str) -> str:
    """Lines in order, as the file of a dimension is."""
    df.orderBy(order).select("value").coalesce(1).write.text(folder)
    return folder


# ---------------------------------------------------------------- dimension files

@query("vendor_file", oracle("""
select upper(right('000000' || printf('%x', p_partkey % 700), 6)) as oui, arg_max(p_brand, p_partkey) as vendor from part group by 1"""))
def vendor_file(spark: SparkSession, sf: str) -> DataFrame:
    """``PREFIX|vendor`` lines, most prefixes several times, some lines without a vendor."""
    part = view(spark, sf, "part")
    lines = part.select("p_partkey", F.concat(F.upper(F.lpad(F.hex(F.col("p_partkey") % 700), 6, "0")), F.lit("|"), "p_brand").alias("value"))
    broken = part.filter("p_partkey % 10 = 0").select(F.col("p_partkey") + 0.5, F.lit("no vendor here").alias("value"))
    return dimensions.vendor_table(spark, one_file(lines.union(broken), "p_partkey", folder_for(spark, "vendors")))


@query("threat_file", oracle("""
select e.event_id, t.score as darklist_score, t.name as darklist_score_name, t.category as darklist_category
from (select event_id, lan_ip, wan_ip from fx_flow) e join (
 select '10.' || (s_suppkey % 4) || '.0.' || (s_suppkey % 50) as ip, arg_max(cast(s_suppkey % 100 as int), s_suppkey) as score, arg_max('n-' || (s_suppkey % 7), s_suppkey) as name,
  arg_max('c-' || (s_suppkey % 5), s_suppkey) as category from supplier group by 1) t on t.ip = e.lan_ip"""))
def threat_file(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON array with doubled addresses; the last entry counts."""
    s = F.col("s_suppkey")
    name = lambda prefix, n: F.concat(F.lit(prefix), (s % n).cast("string"))
    what = F.struct((s % 100).cast("int").alias("darklist_score"), name("n-", 7).alias("darklist_score_name"), name("c-", 5).alias("darklist_category"))
    entry = F.struct(s.alias("at"), F.concat(F.lit("10."), (s % 4).cast("string"), F.lit(".0."), (s % 50).cast("string")).alias("ip"), what.alias("enrich_with"))
    array = view(spark, sf, "supplier").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("value"))  # the file is one value
    threats = dimensions.threat_table(spark, one_file(array.withColumn("n", F.lit(0)), "n", folder_for(spark, "threats")))
    flows = view(spark, sf, "fx_flow").select("event_id", F.col("lan_ip").alias("ip"))
    return flows.join(threats, "ip").select("event_id", "darklist_score", "darklist_score_name", "darklist_category")


def ranged_flows(spark: SparkSession, sf: str, table: DataFrame, name: str) -> DataFrame:
    """Flows with range tables that were written to files and read back."""
    folder = folder_for(spark, name)
    table.union(table.limit(10)).write.parquet(folder)  # doubled rows never double a flow
    countries, networks = dimensions.range_tables(spark, folder, folder)
    return ranges.geo_lookup(view(spark, sf, "fx_flow"), countries, networks)


@query("range_files", oracle(geo_body("coalesce(wan_cc, lan_cc) as ip_country_code, coalesce(wan_as, lan_as) as ip_as_name")))
def range_files(spark: SparkSession, sf: str) -> DataFrame:
    return ranged_flows(spark, sf, view(spark, sf, "fx_geo"), "ranges").select("event_id", "ip_country_code", "ip_as_name")


V6 = "2a02:26f0:0008:0183:0000:0000:0000:"
NESTED = [("0000", "9999", "WIDE", "AS1 Wide Net"), ("1000", "4fff", "MID", "AS2 Mid Net"), ("1500", "15ff", "SMALL", "AS3"), ("1500", "1510", "LEAST", "AS4 Least Net"), ("9000", "9fff", "HIGH", "AS5 High Net")]


@query("geoip_v6", oracle("""
select event_id, wan_ip, case when substr(wan_ip, 36) between '1500' and '1510' then 'LEAST' when substr(wan_ip, 36) between '1500' and '15ff' then 'SMALL'
  when substr(wan_ip, 36) between '1000' and '4fff' then 'MID' when substr(wan_ip, 36) between '9000' and '9fff' then 'HIGH' when substr(wan_ip, 36) between '0000' and '9999' then 'WIDE' end as wan_ip_country_code,
  case when substr(wan_ip, 36) between '1500' and '1510' then 'Least Net' when substr(wan_ip, 36) between '1500' and '15ff' then 'AS3'
  when substr(wan_ip, 36) between '1000' and '4fff' then 'Mid Net' when substr(wan_ip, 36) between '9000' and '9fff' then 'High Net' when substr(wan_ip, 36) between '0000' and '9999' then 'Wide Net' end as wan_ip_as_name
from fx_flow where event_id % 50 = 0"""))
def geoip_v6(spark: SparkSession, sf: str) -> DataFrame:
    """Version 6 addresses in nested and crossing ranges: the latest start wins, then the earliest end."""
    table = spark.createDataFrame([(6, V6 + a, V6 + b, cc, owner) for a, b, cc, owner in NESTED], "family int, start_ip string, end_ip string, country_code string, as_info string")
    flows = view(spark, sf, "fx_flow").filter("event_id % 50 = 0")
    return ranges.geo_lookup(flows, table, table).select("event_id", "wan_ip", "wan_ip_country_code", "wan_ip_as_name")


# ---------------------------------------------------------------- snapshots and state of streams

@query("stream_dimension_refresh", oracle("""
select event_id, 'v' || (case when event_id < q.a then 0 when event_id < q.b then 0 else 2 end) || '-' || application_id_name as name
from fx_flow, (select (max(event_id) + 1) // 3 as a, (max(event_id) + 1) * 2 // 3 as b from fx_flow) q"""))
def stream_dimension_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that changes with every micro-batch and is read anew every second one; each batch keeps to the snapshot it has pinned."""
    flows, folder = view(spark, sf, "fx_flow").select("event_id", "application_id_name"), folder_for(spark, "pinned")
    at = [0]

    def load() -> DataFrame:
        return view(spark, sf, "fx_flow").select("application_id_name").distinct().withColumn("name", F.concat(F.lit(f"v{at[0]}-"), "application_id_name"))
    pinned = PinnedDimension(spark, folder, load, every=2)

    def write(batch: DataFrame, batch_id: int) -> None:
        at[0] = batch_id
        for _ in range(2):  # the second time as after a failure: the source has moved on, the snapshot has not
            out = lookup.lookup_chain(batch, [lookup.StoreSpec("names", pinned.at(batch_id), keys=("application_id_name",))])
            out.select("event_id", "name").write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
            at[0] = 99
    total = flows.count()
    for i in range(3):
        flows.filter(f"event_id >= {total * i // 3} and event_id < {total * (i + 1) // 3}").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(flows.schema).parquet(f"{folder}/in").writeStream.foreachBatch(write)
        stream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@query("stream_client_asof", oracle("""
select m.event_id, m."timestamp", m.client_mac, m.namespace_uuid, m.vlan_id, i.wireless_station, i.wireless_id, i.lan_vlan, i.last_seen
from masked m left join latest l on l.event_id = m.event_id left join known i on i.event_id = l.iid and m."timestamp" - i.last_seen < 7200 where m.type = 'measure'""", f"""
masked as (select * replace (case when event_id % 3 <> 0 then client_mac end as client_mac) from fx_nmsp),
known as (select event_id, client_mac, namespace_uuid, wireless_station, wireless_id, vlan_id as lan_vlan, "timestamp" as last_seen from masked where type = 'info' and client_mac is not null),
both_kinds as (select client_mac, namespace_uuid, last_seen as ts, 0 as rk, event_id, event_id as iid from known
 union all select client_mac, namespace_uuid, "timestamp", 1, event_id, null from masked where type = 'measure' and client_mac is not null),
latest as (select * from (select event_id, rk, last_value(iid ignore nulls) over (partition by client_mac, namespace_uuid order by ts, rk, event_id {RUNNING}) as iid from both_kinds) t where rk = 1)"""))
def stream_client_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Measures with the association of their client, at most two hours old, from keyed state that expires; a third have no client."""
    df = view(spark, sf, "fx_nmsp").withColumn("client_mac", F.when(F.col("event_id") % 3 != 0, F.col("client_mac")))
    folder = folder_for(spark, "client-asof")
    for stream in in_parts(spark, df, "timestamp", folder, 2):
        info = nmsp.info_state(nmsp.nmsp_info(stream))
        probes = stream.filter("type = 'measure'").select("event_id", "timestamp", "client_mac", "namespace_uuid", "vlan_id")
        out = run_available(stream_asof(probes, {"i": info}, nmsp.KEYS, ttl_seconds=7200, max_age=7200), folder, provider=ROCKSDB)
    return out.select("event_id", "timestamp", "client_mac", "namespace_uuid", "vlan_id", *[F.col(f"i.{c}") for c in ("wireless_station", "wireless_id", "lan_vlan", "last_seen")])


# ---------------------------------------------------------------- histograms and index tables that merge

SHARES = (0.5, 0.9, 0.99)


@query("rollup_location_quantiles", oracle("""
select "timestamp" - "timestamp" % 86400 as "timestamp", type, count(*) filter (dwell_time between 3 and 1440) as n, count(*) filter (dwell_time between 3 and 1440) as in_buckets,
  true as p50_near, true as p90_near, true as p99_near, true as once_p50_near, true as once_p90_near, true as once_p99_near from fx_measure group by 1, 2"""))
def rollup_location_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Dwell quantiles of a day, from its minutes' sketches merged and from one sketch of the day, held against exact ranks."""
    rows, spec = view(spark, sf, "fx_measure"), replace(rollup.LOCATION, dims=("type",))
    minutes = rollup.rollup(rows, spec, mode="sketch")
    merged = rollup.merge_rollups(minutes, spec, ["type"], "1 day")
    in_day = rows.withColumn("day", F.col("timestamp") - F.col("timestamp") % 86400)
    once = rollup.rollup(in_day.drop("timestamp").withColumnRenamed("day", "timestamp"), spec, mode="sketch")
    found = merged.select(F.col("timestamp").alias("day"), "type", rollup.quantiles("hist_dwell_sketch", SHARES).alias("q"),
                          F.aggregate(rollup.buckets("hist_dwell_sketch"), F.lit(0.0), lambda a, x: a + x["count"]).alias("filled"))
    found = found.join(once.select(F.col("timestamp").alias("day"), "type", rollup.quantiles("hist_dwell_sketch", SHARES).alias("once")), ["day", "type"])
    held = in_day.filter(F.col("dwell_time").between(rollup.HISTOGRAM_LOW, rollup.HISTOGRAM_HIGH)).join(found, ["day", "type"])

    def near(values: str, i: int, p: float, name: str):
        # of equal values any rank between the first and the last is right
        below, upto = (F.count_if(test) / F.count("*") for test in (F.col("dwell_time") < F.get(values, F.lit(i)), F.col("dwell_time") <= F.get(values, F.lit(i))))
        return ((below <= p + rollup.RANK_ERROR) & (upto >= p - rollup.RANK_ERROR)).alias(name)
    checks = [near(v, i, p, f"{tag}p{round(100 * p)}_near") for v, tag in (("q", ""), ("once", "once_")) for i, p in enumerate(SHARES)]
    return held.groupBy(F.col("day").alias("timestamp"), "type").agg(F.count("*").alias("n"), F.round(F.first("filled")).cast("bigint").alias("in_buckets"), *checks)


@query("index_merged_minutes", oracle("""
select case when namespace_uuid is null then 'rb_location' else 'rb_location_' || namespace_uuid end as datasource, "timestamp" - "timestamp" % 60 as "timestamp", type, sensor_uuid,
  count(*) as events, cast(sum(dwell_time) as bigint) as sum_dwell_time, cast(sum(client_rssi_num) as bigint) as sum_rssi, cast(sum(repetitions) as bigint) as sum_repetitions,
  count(distinct client_mac) as clients, count(distinct session) as sessions, true as clients_near, true as sessions_near,
  count(*) filter (dwell_time < 3) as hist_dwell_below, count(*) filter (dwell_time > 1440) as hist_dwell_above from fx_measure group by 1, 2, 3, 4"""))
def index_merged_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Every minute comes in each of three micro-batches, and stays one row."""
    rows, folder = view(spark, sf, "fx_measure").drop("client_latlong"), folder_for(spark, "index")
    rows = rows.select("event_id", "timestamp", "type", "sensor_uuid", "namespace_uuid", "client_mac", "session", "dwell_time", "client_rssi_num", "popularity", "repetitions")
    sink = index_sink(folder, "location", lambda batch: {"rb_loc_post": batch.drop("event_id")}, part_seconds=86_400)  # the table's minutes span a month
    for i in range(3):
        rows.filter(F.col("event_id") % 3 == i).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in").writeStream.foreachBatch(sink)
        stream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    dims = ["datasource", "timestamp", "type", "sensor_uuid"]
    named = rows.withColumn("datasource", F.when(F.col("namespace_uuid").isNull(), "rb_location").otherwise(F.concat(F.lit("rb_location_"), "namespace_uuid")))
    exact = rollup.rollup(named, replace(rollup.LOCATION, dims=("type", "sensor_uuid")), "exact", extra_dims=("datasource",))
    estimate = read_index(spark, folder, "location")
    sums = ["events", "sum_dwell_time", "sum_rssi", "sum_repetitions", "hist_dwell_below", "hist_dwell_above"]
    known = compare(exact.select(*dims, "clients", "sessions"), estimate, dims, ["clients", "sessions"])
    return estimate.select(*dims, *sums).join(known.withColumnRenamed("sensor_uuid", "s"), (F.col("s") == F.col("sensor_uuid")) & (estimate["datasource"] == known["datasource"])
                                             & (estimate["timestamp"] == known["timestamp"]) & (estimate["type"] == known["type"])).select(
        *[estimate[c] for c in (*dims, *sums)], "clients", "sessions", "clients_near", "sessions_near")
