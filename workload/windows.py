"""Metrics, rollup, counter and routing queries."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.fields import ROUTES
from flowloom.operators import counters, metrics, records, rollup
from flowloom.plans.index import index
from flowloom.plans.route import route
from flowloom.sources.topics import keyed_output, parse_json
from workload.catalog import query
from workload.near import near_exact, near_sql
from workload.scalar import SLICES, SRC_PLAIN
from workload.views import oracle, view

# ---------------------------------------------------------------- metrics


@query("metrics_flatten", oracle("""
select event_id, ts as "timestamp", 'flow-' || part as sensor_name, type, type || '_' || metric as monitor, value from (
 select event_id, "timestamp" as ts, cast(event_id % 4 as varchar) as part, 'flowstep' as type, 'messages' as metric, value from fx_measure
 union all select event_id, "timestamp", cast(event_id % 4 as varchar), 'flowstep', 'errors', value / 2 from fx_measure
 union all select event_id, "timestamp", cast(event_id % 4 as varchar), 'store', 'gets', value from fx_measure where event_id % 3 = 0) t"""))
def metrics_flatten(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda v: F.lit(v)
    classes = F.create_map(
        text("org.example.Steps.FlowStep"), F.create_map(text("messages"), F.col("value"), text("errors"), F.col("value") / 2),
        text("java.lang.Runtime"), F.create_map(text("gc"), F.col("value")))
    more = F.create_map(text("ORG.Example.Store"), F.create_map(text("gets"), F.col("value")))
    source = F.concat(F.lit("TaskName-Partition "), (F.col("event_id") % 4).cast("string"))
    header = F.struct((F.col("timestamp") * 1000 + 5).alias("time"), source.alias("source"), F.lit("flow").alias("container-name"))
    snapshot = F.struct(header.alias("header"), F.when(F.col("event_id") % 3 == 0, F.map_concat(classes, more)).otherwise(classes).alias("metrics"))
    df = view(spark, sf, "fx_measure").select("event_id", snapshot.alias("asMap"))
    return metrics.flatten_job_metrics(df, "org.example")


SERVICES = ["historical", "realtime", "coordinator", "overlord", "indexer", "broker"]
NAMES = ["segment/max", "query/time", "coordinator/segment/size", "jvm/mem"]
PICK = lambda values, by: "case " + by + " " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"
IS_QUERY, OVERLORD = "instr(metric, 'query') > 0", "service in ('overlord', 'indexer')"


@query("druid_metrics_flatten", oracle(f"""
select event_id, "timestamp", host as sensor_name, service || '/' || metric as monitor, value,
 case when {IS_QUERY} then u2 when service = 'historical' then u1 when service = 'realtime' then u2 when {OVERLORD} then u2
  when service = 'coordinator' and metric = 'coordinator/segment/size' then u1 end as data_source,
 case when service = 'historical' then u2 end as tier,
 case when service = 'coordinator' and metric <> 'coordinator/segment/size' then u1 end as historical_server,
 case when {OVERLORD} then u3 end as task_status, case when {OVERLORD} then u4 end as task_type, case when {OVERLORD} then u5 end as segment_interval,
 case when {IS_QUERY} then u3 end as query_context_dump, case when {IS_QUERY} then u4 end as query_type, case when {IS_QUERY} then u5 end as query_interval,
 case when {IS_QUERY} then u8 end as query_id, case when {IS_QUERY} then u9 end as query_duration
from (select event_id, "timestamp", sensor_uuid as host, value, {PICK(SERVICES, 'event_id % 6')} as service, {PICK(NAMES, '(event_id // 6) % 4')} as metric,
 'u1-' || event_id as u1, 'u2-' || event_id as u2, 'u3-' || event_id as u3, 'u4-' || event_id as u4, 'u5-' || event_id as u5, 'u8-' || event_id as u8, 'u9-' || event_id as u9 from fx_measure) t"""))
def druid_metrics_flatten(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    stamp = F.date_format(F.timestamp_seconds(F.col("timestamp")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    user = lambda n: F.concat(F.lit(f"u{n}-"), i.cast("string")).alias(f"user{n}")
    item = F.struct(
        stamp.alias("timestamp"), F.col("sensor_uuid").alias("host"), pick(SERVICES, i % 6).alias("service"),
        pick(NAMES, F.floor(i / 6) % 4).alias("metric"), "value", *[user(n) for n in (1, 2, 3, 4, 5, 8, 9)])
    return metrics.flatten_service_metrics(view(spark, sf, "fx_measure").select("event_id", F.array(item).alias("metrics")))


# ---------------------------------------------------------------- rollups

# Columns a rollup needs that go by another name in the measurement view.
RENAMED = {
    "social": {"endpoint_uuid": "user_screen_name"},
    "appmobile_signal": {"signal_strength": "signalStrength", "session": "IMEI"},
    "appmobile_call": {"session": "IMEI"},
    "changes": {"ioc": "s3_old", "hash": "md5"},
    "vault": {"msg": "message", "endpoint_uuid": "hostname"},
    "ioc": {"type": "action"},
    "location": {"session": "session", "ioc": "new"},
    "malware": {"ioc": "file_name"},
    "event": {"ioc": "action"},
    "hashtag": {},
    "state": {},
    "iot": {},
    "monitor": {},
}
START, SQUEEZE = 1704067200, 720
ROUNDED = {"sum_value", "sum_popularity", "sum_signal_strength", "sum_duration"}


def measured(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # an hour of minutes holds the month of events, so that groups have several rows
    dense = F.lit(START) + F.expr(f"(timestamp - {START}) div {SQUEEZE}")
    df = view(spark, sf, "fx_measure").withColumn("timestamp", dense)
    return df.withColumnsRenamed(RENAMED[name]).drop("event_id")


def rollup_sql(name: str) -> str:
    spec = rollup.SPECS[name]
    back = {new: old for old, new in RENAMED[name].items()}
    base = ["timestamp", "type", "monitor", "value", "sensor_uuid", "namespace_uuid", "client_mac", "wireless_station", "wireless_channel",
            "wireless_tx_power", "client_rssi_num", "dwell_time", "session", "popularity", "repetitions", "hash", "msg", "endpoint_uuid", "ioc",
            "followers", "duration", "signal_strength"]
    have = [RENAMED[name].get(c, c) for c in base]
    # a schemaless rollup groups by whatever the records carry
    dims = [d for d in (spec.dims or [c for c in have if c not in ("timestamp", "value", *spec.exclude)]) if d in have]
    column = lambda c: f'"{back.get(c, c)}"'
    out = ['"timestamp" - "timestamp" % 60 as "timestamp"', *[f'{column(d)} as "{d}"' for d in dims]]
    for alias, (kind, source) in spec.aggs.items():
        c = column(source) if source in have else "null"
        if kind == "count":
            out.append(f"count(*) as {alias}")
        elif kind == "lsum":
            out.append(f"cast(coalesce(sum({c}), 0) as bigint) as {alias}")
        elif kind == "dsum":
            out.append(f"round(coalesce(sum({c}), 0), 4) as {alias}")
        elif kind in ("min", "max"):
            out.append(f"cast({kind}({c}) as double) as {alias}")
        elif kind == "distinct":
            out.append(f"count(distinct {c}) as {alias}")
        else:
            out += [f"count(*) filter ({c} < 3) as {alias}_below", f"count(*) filter ({c} > 1440) as {alias}_above",
                    f"count({c}) filter ({c} between 3 and 1440) as {alias}_inside"]
    groups = ", ".join(str(i + 1) for i in range(len(dims) + 1))
    dense = f'select * replace ({START} + ("timestamp" - {START}) // {SQUEEZE} as "timestamp") from fx_measure'
    return oracle(f"select {', '.join(out)} from dense group by {groups}", f"dense as ({dense})")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in df.columns if c in ROUNDED})


def _register_rollups() -> None:
    for name in RENAMED:
        def exact(spark: SparkSession, sf: str, name: str = name) -> DataFrame:
            return _rounded(rollup.rollup(measured(spark, sf, name), rollup.SPECS[name], mode="exact"))
        query(f"rollup_{name}", rollup_sql(name))(exact)
        kinds = {kind for kind, _ in rollup.SPECS[name].aggs.values()}
        if kinds & {"distinct", "histogram"}:
            def approx(spark: SparkSession, sf: str, name: str = name) -> DataFrame:
                return _rounded(near_exact(measured(spark, sf, name), rollup.SPECS[name]))
            query(f"rollup_{name}_approx", near_sql(rollup_sql(name), rollup.SPECS[name]))(approx)


_register_rollups()

BIN_SQL = "case when dwell_time between 3 and 1440 then least(49, cast(floor((dwell_time - 3) * 50 / 1437.0) as bigint)) end"


@query("rollup_location_merged", oracle(f"""
select "timestamp" - "timestamp" % 3600 as "timestamp", type, count(*) as events, cast(sum(dwell_time) as bigint) as sum_dwell_time,
  count(*) filter (dwell_time < 3) as hist_dwell_below, count(*) filter (dwell_time > 1440) as hist_dwell_above,
  concat_ws(',', {', '.join(f'count(*) filter (bin = {i})' for i in range(rollup.HISTOGRAM_BINS))}) as hist_dwell
from (select *, {BIN_SQL} as bin from fx_measure) t group by 1, 2"""))
def rollup_location_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly dwell histograms from minute rollups."""
    spec = replace(rollup.LOCATION, dims=("type",))
    minutes = rollup.rollup(view(spark, sf, "fx_measure"), spec, mode="sketch")
    hours = rollup.merge_rollups(minutes, spec, ["type"])
    return hours.select("timestamp", "type", "events", "sum_dwell_time", "hist_dwell_below", "hist_dwell_above",
                        F.array_join(F.col("hist_dwell").cast("array<string>"), ",").alias("hist_dwell"))


# ---------------------------------------------------------------- counters

NAMED = """named as (select *, case when namespace_uuid is null then 'rb_flow' else 'rb_flow_' || namespace_uuid end as datasource from fx_flow)"""


def named_flows(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_flow").withColumn("datasource", counters.datasource_name("rb_flow", F.col("namespace_uuid")))


@query("window_counts", oracle("""
select ws + 60 as "timestamp", 'enrichmentstreamtask' as type, 'enrichmentstreamtask_messages' as monitor, 'task-0-0-' || datasource as sensor_name,
  n as value, case when len(string_split(datasource, '_')) >= 3 then string_split(datasource, '_')[-1] end as namespace_uuid
from (select datasource, "timestamp" - "timestamp" % 60 as ws, count(*) as n from named group by 1, 2) t""", NAMED))
def window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counters.window_counts(named_flows(spark, sf))


TOPIC_SQL = PICK(["rb_flow_post", "rb_monitor", "rb_event_post", "rb_state_post", "rb_social", "rb_loc_post", "other", "rb_iot_post"], "event_id % 8")


@query("stream_counts", oracle("""
select fam || case when namespace_uuid is null then '' else '_' || namespace_uuid end as stream, count(*) as events
from (select namespace_uuid, case when instr(topic, 'rb_flow') > 0 then 'rb_flow' when instr(topic, 'rb_monitor') > 0 then 'rb_monitor' when instr(topic, 'rb_event') > 0 then 'rb_event'
  when instr(topic, 'rb_state') > 0 then 'rb_state' when instr(topic, 'rb_social') > 0 then 'rb_social' else '' end as fam from topical) t group by 1""",
    f"topical as (select *, {TOPIC_SQL} as topic from fx_flow)"))
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counters.stream_counts(view(spark, sf, "fx_flow").withColumn("topic", F.expr(TOPIC_SQL)))


PREV_SQL = """
select n.event_id, n.datasource, case when n.ws > f.first_ws then coalesce(c.n, 0) end as flows_count
from (select *, "timestamp" - "timestamp" % 60 as ws from named) n
join (select datasource, min("timestamp" - "timestamp" % 60) as first_ws from named group by 1) f on f.datasource = n.datasource
left join (select datasource, "timestamp" - "timestamp" % 60 as ws, count(*) as n from named group by 1, 2) c on c.datasource = n.datasource and c.ws = n.ws - 60"""


@query("prev_window_count", oracle(PREV_SQL, NAMED))
def prev_window_count(spark: SparkSession, sf: str) -> DataFrame:
    out = counters.with_prev_window_count(named_flows(spark, sf))
    return out.select("event_id", "datasource", "flows_count")


CAPACITY = NAMED + """,
 loads as (select datasource, ws, row_number() over (partition by datasource order by ws) as k, (events // 3600) * 4 as load from
  (select datasource, "timestamp" - "timestamp" % 3600 as ws, cast(sum(bytes) as bigint) as events from named group by 1, 2) t),
 limits as (select datasource, max(k) as n, case when datasource = 'rb_flow' then 1 else 6 end as lim, case when datasource = 'rb_flow' then 0 else 2 end as index_replicas from loads group by 1),
 runs as (select o.datasource, o.ws, o.k, least(greatest(ceil(o.load / 200.0), 1), l.lim) as current from loads o join limits l on l.datasource = o.datasource where o.k = 1
  union all select o.datasource, o.ws, o.k, case when r.current * 200 * 0.8 <= o.load then least(greatest(ceil(o.load / 200.0), 1), l.lim)
   when r.current * 200 * 0.2 >= o.load then least(greatest(ceil(o.load / 200.0), 1), r.current) else r.current end
  from runs r join loads o on o.datasource = r.datasource and o.k = r.k + 1 join limits l on l.datasource = o.datasource)"""


def hourly_load(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Counts and limits, with bytes standing in for messages so that the load moves."""
    start = F.col("timestamp") - F.col("timestamp") % 3600
    counts = named_flows(spark, sf).groupBy("datasource", start.alias("window_start")).agg(F.sum("bytes").alias("events"))
    plain = F.col("datasource") == "rb_flow"
    limits = counts.select("datasource").distinct().withColumns({
        "index_partitions": F.when(plain, 1).otherwise(6), "index_replicas": F.when(plain, 0).otherwise(2)})
    return counts, limits


@query("capacity_report", oracle("""
select r.datasource, cast(current as int) as partitions, cast(greatest(l.index_replicas, 1) as int) as replicas, cast(r.k as int) as windows
from runs r join limits l on l.datasource = r.datasource where r.k = l.n""", CAPACITY))
def capacity_report(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions after the last hour."""
    counts, limits = hourly_load(spark, sf)
    return counters.capacity_report(counts, limits, seconds=3600, per_task=200)


# ---------------------------------------------------------------- routing and topics


EVERY_TOPIC = PICK([topic for topic, _, _ in ROUTES] + ["other"], f"event_id % {len(ROUTES) + 1}")


def route_case(part: int) -> str:
    return "case topic " + " ".join(f"when '{r[0]}' then '{r[part]}'" for r in ROUTES) + " end"


@query("index_all_topics", oracle(f"""
select base || case when namespace_uuid is null then '' else '_' || namespace_uuid end as datasource, "timestamp" - "timestamp" % 60 as "timestamp", count(*) as events,
  round(sum(case when target in ('state', 'monitor', 'iot') then value else 0 end), 3) as sum_value,
  cast(sum(case when target = 'location' then dwell_time else 0 end) as bigint) as sum_dwell_time
from (select *, {route_case(1)} as target, {route_case(2)} as base from topical) t where base is not null group by 1, 2""",
    f"topical as (select *, {EVERY_TOPIC} as topic from fx_measure)"))
def index_all_topics(spark: SparkSession, sf: str) -> DataFrame:
    """All indexed topics through the index job; counts and sums per datasource and minute."""
    records = view(spark, sf, "fx_measure").withColumn("topic", F.expr(EVERY_TOPIC))
    topics = {topic: records.filter(F.col("topic") == topic).drop("topic", "event_id").withColumnsRenamed(RENAMED.get(target, {})) for topic, target, _ in ROUTES}
    zero = lambda df, c, kind: (F.col(c) if c in df.columns else F.lit(0)).cast(kind).alias(c)
    parts = [df.select("datasource", "timestamp", "events", zero(df, "sum_value", "double"), zero(df, "sum_dwell_time", "bigint")) for df in index(topics).values()]
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("datasource", "timestamp").agg(
        F.sum("events").alias("events"), F.round(F.sum("sum_value"), 3).alias("sum_value"), F.sum("sum_dwell_time").alias("sum_dwell_time"))


# dimensions that the flow view lacks get a value made from their name
FLOW_OWN = {"application_id_name", "client_mac", "namespace_uuid", "service_provider_uuid", "lan_ip", "wan_ip", "duration"}
FLOW_MADE = [d for d in rollup.FLOW.dims if d not in FLOW_OWN]


@query("rollup_flow", oracle(f"""
select st - st % 60 as "timestamp", {', '.join('cast(spent as varchar) as duration' if d == 'duration' else d for d in rollup.FLOW.dims)}, count(*) as events,
  cast(sum(slice_bytes) as bigint) as sum_bytes, cast(sum(slice_pkts) as bigint) as sum_pkts, cast(sum(client_rssi_num) as bigint) as sum_rssi,
  count(distinct client_mac) as clients, count(distinct wireless_station) as wireless_stations
from (select s.st, s.bytes as slice_bytes, s.pkts as slice_pkts, case when s.k = 1 then s.duration end as spent, f.*, -(f.event_id % 90) as client_rssi_num,
  {', '.join(f"'{d}-' || (f.event_id % {2 + i % 3}) as {d}" for i, d in enumerate(FLOW_MADE))} from slices s join fx_flow f on f.event_id = s.event_id) s group by all""", SRC_PLAIN + "," + SLICES))
def rollup_flow(spark: SparkSession, sf: str) -> DataFrame:
    """All dimensions and aggregators of the flow datasource."""
    i = F.col("event_id")
    made = {d: F.concat(F.lit(f"{d}-"), (i % (2 + n % 3)).cast("string")) for n, d in enumerate(FLOW_MADE)}
    apart = rollup.Apart(rollup.FLOW)
    flows = records.flow(view(spark, sf, "fx_flow").withColumns({**made, "client_rssi_num": -(i % 90)}), now="arrival", before_split=apart.take)
    return rollup.rollup(flows, rollup.FLOW, mode="exact", complete=True, apart=apart)


@query("route_datasource", oracle("""
select event_id, topic, target, case when base is not null then base || case when namespace_uuid is null then '' else '_' || namespace_uuid end end as datasource
from (select *, """ + route_case(1) + " as target, " + route_case(2) + """ as base from topical) t""",
    f"topical as (select *, {EVERY_TOPIC} as topic from fx_flow)"))
def route_datasource(spark: SparkSession, sf: str) -> DataFrame:
    out = route(view(spark, sf, "fx_flow").withColumn("topic", F.expr(EVERY_TOPIC)))
    return out.select("event_id", "topic", "target", "datasource")


RAW = """case event_id % 6 when 0 then props when 1 then '[1, ' || event_id || ']' when 2 then '"text"' when 3 then '{"k": 1' when 4 then cast(event_id as varchar(20))
 else ' {"k": ' || event_id || ', "other": [1]}' end"""


@query("reject_non_object", """
select event_id, ok, case when ok then cast(json_extract(value, '$.k') as bigint) end as k, case when not ok then value end as rejected
from (select event_id, value, case when json_valid(value) then json_type(value) = 'OBJECT' else false end as ok
 from (select event_id, """ + RAW + """ as value from events) t) u""")
def reject_non_object(spark: SparkSession, sf: str) -> DataFrame:
    raw = view(spark, sf, "events").select("event_id", F.expr(RAW).alias("value"))
    good, bad = parse_json(raw, "k bigint")
    none = lambda kind: F.lit(None).cast(kind)
    return good.select("event_id", F.lit(True).alias("ok"), "k", none("string").alias("rejected")).unionByName(
        bad.select("event_id", F.lit(False).alias("ok"), none("bigint").alias("k"), F.col("value").alias("rejected")))


@query("keyed_output", oracle("""
select event_id as id, client_mac as key, '{"event_id":' || event_id || ',"client_mac":"' || client_mac || '","pkts":' || pkts || '}' as value from fx_flow"""))
def keyed_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = view(spark, sf, "fx_flow").select("event_id", "client_mac", "pkts")
    out = keyed_output(df, F.col("client_mac"))
    return out.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("id"), "key", "value")
