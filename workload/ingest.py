"""Topics from JSON text to enriched records: numbers as text, fields outside the schema, learned and static stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators.lookup import LearnedStore, StoreSpec
from flowloom.plans.states import learned_states
from flowloom.plans.topics import Context, run_topic
from flowloom.sources.topics import parse_json
from workload.catalog import query
from workload.clients import JUDGED, RUNNING, SEEN, accounting, as_notification, followed_sql, places
from workload.scalar import CALLED, LABEL, PROFILE, SLICES, SRC_PLAIN
from workload.views import oracle, view


def messages(df: DataFrame, topic: str, body: list[Column], keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The columns of ``body`` as JSON text, read back through the topic's schema."""
    raw = df.select(*keep, F.to_json(F.struct(*body)).alias("value"))
    good, _ = parse_json(raw, fields.SCHEMAS[topic], extras=True)
    return good


def text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


@query("ingest_flow", oracle("""
select s.event_id, st as "timestamp", s.bytes, s.pkts, case when k = 1 then duration end as duration, client_mac, 'agent-' || (s.event_id % 5) as http_user_agent
from slices s""", SRC_PLAIN + "," + SLICES))
def ingest_flow(spark: SparkSession, sf: str) -> DataFrame:
    df = view(spark, sf, "fx_flow")
    agent = F.concat(F.lit("agent-"), (F.col("event_id") % 5).cast("string")).alias("http_user_agent")
    rows = messages(df, fields.FLOW, [text("timestamp"), text("first_switched"), "bytes", text("pkts"), "client_mac", "namespace_uuid", agent], ("event_id", "arrival"))
    out, = run_topic(rows, fields.FLOW, Context())
    return out.select("event_id", "timestamp", "bytes", "pkts", "duration", "client_mac", F.try_element_at("extras", F.lit("http_user_agent")).alias("http_user_agent"))


@query("ingest_event", oracle("""
select event_id, "timestamp", msg, hash as sha256, cast(wireless_channel as varchar) as ttl from fx_measure"""))
def ingest_event(spark: SparkSession, sf: str) -> DataFrame:
    body = [text("timestamp"), "msg", "client_mac", F.col("hash").alias("sha256"), F.col("wireless_channel").alias("ttl")]
    out, = run_topic(messages(view(spark, sf, "fx_measure"), fields.EVENT, body), fields.EVENT)
    extra = lambda c: F.try_element_at("extras", F.lit(c)).alias(c)
    return out.select("event_id", "timestamp", "msg", extra("sha256"), extra("ttl"))


@query("ingest_nmsp_topic", oracle(f"""
select event_id, "timestamp", 'nmsp-measure' as type, client_mac, namespace_uuid, client_rssi_num, wireless_station, wireless_id, lan_vlan, last_seen,
  {LABEL.format('client_rssi_num', 'excellent')} as client_rssi, {PROFILE.format('client_rssi_num')} as client_profile,
  case when joined then 'ASSOCIATED' else 'PROBING' end as dot11_status, case when joined then 'ch-' || (iid % 11) end as wireless_channel,
  case when joined then '802.11n' end as dot11_protocol
from (select j.*, d.iid from judged j join decided d on d.event_id = j.event_id) t where client_rssi_num >= -80 or joined
union all select event_id, "timestamp", 'nmsp-info', client_mac, namespace_uuid, null, wireless_station, wireless_id, lan_vlan, last_seen,
  null, 'hard', 'ASSOCIATED', 'ch-' || (event_id % 11), '802.11n' from info""", JUDGED))
def ingest_nmsp_topic(spark: SparkSession, sf: str) -> DataFrame:
    channel = F.concat(F.lit("ch-"), (F.col("event_id") % 11).cast("string")).alias("wireless_channel")
    body = [text("timestamp"), "type", "client_mac", "namespace_uuid", "ap_mac", F.transform("rssi", lambda x: x.cast("string")).alias("rssi"),
            "wireless_station", "wireless_id", text("vlan_id"), channel, F.lit("802.11n").alias("dot11_protocol")]
    out, = run_topic(messages(view(spark, sf, "fx_nmsp"), fields.NMSP, body), fields.NMSP)
    return out.select("event_id", "timestamp", "type", "client_mac", "namespace_uuid", "client_rssi_num", "wireless_station", "wireless_id", "lan_vlan",
                      "last_seen", "client_rssi", "client_profile", "dot11_status", "wireless_channel", "dot11_protocol")


@query("ingest_location_topic", f"select * replace (event_id // 3 as event_id) from ({followed_sql('first_value')}) each_one")
def ingest_location_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that hold three notifications each."""
    df = view(spark, sf, "fx_location10")
    one = F.struct(F.col("event_id").alias("order"), as_notification().alias("n"))
    grouped = df.groupBy(F.expr("event_id div 3").alias("event_id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["n"]).alias("notifications"))
    out, = run_topic(messages(grouped, fields.LOC, ["notifications"]), fields.LOC)
    # version 8/9 records have more fields
    return out.select(*[c for c in out.columns if c in LOCATION_COLUMNS])


LOCATION_COLUMNS = ["event_id", "timestamp", "type", "client_mac", "namespace_uuid", "dot11_status", "wireless_station", "client_id", "campus", "building", "floor",
                    "client_profile", "market", "sensor_name", "service_provider", "zone", "wireless_id", "dot11_protocol", "client_latlong", "subscriptionName"]


@query("ingest_radius", oracle(f"""
select id as event_id, "timestamp", 'radius' as type, replace(lower(calling_station_id), '-', ':') as client_mac, namespace_uuid, user_name as client_id,
  coalesce(case when {CALLED} then substr(called_station_id, 19) end, case when id % 9 = 0 then '19' end) as wireless_id,
  lower(acct_status_type) as client_accounting_type, case when id % 10 = 0 then cast(id as varchar) else 'own-sensor' end as sensor_uuid from fx_radius"""))
def ingest_radius(spark: SparkSession, sf: str) -> DataFrame:
    df = accounting(spark, sf)
    body = [text(c) if c == "timestamp" else F.col(f"`{c}`") for c in df.columns if c not in ("id", "event_id")]
    out, = run_topic(messages(df, fields.RADIUS, body), fields.RADIUS)
    return out.select("event_id", "timestamp", "type", "client_mac", "namespace_uuid", "client_id", "wireless_id", "client_accounting_type", "sensor_uuid")


# ---------------------------------------------------------------- all learned states and a table between them

ALL_SEEN = SEEN + f""",
 loc as (select event_id, client_mac, namespace_uuid, "timestamp", 'C' || (event_id % 3) as campus, 'B' || (event_id % 4) as building,
   case when event_id % 2 = 1 then 'ASSOCIATED' else 'PROBING' end as status, case when event_id % 2 = 1 then 'lap-' || (event_id % 5) end as station from fx_flow where event_id % 7 = 1
  union all select event_id, client_mac, null, "timestamp", null, null, case when event_id % 3 = 0 then 'ASSOCIATED' else 'PROBING' end, 'cloud-' || (event_id % 2) from fx_flow where event_id % 7 = 4),
 rad as (select event_id, replace(lower(client_mac), '-', ':') as client_mac, namespace_uuid, "timestamp", 'u-' || event_id as client_id, 'net' as ssid from fx_flow where event_id % 11 = 2),
 pms as (select event_id, client_mac, namespace_uuid, "timestamp", 'g-' || event_id as name from fx_flow where event_id % 13 = 3),
 moves as (select client_mac, namespace_uuid, "timestamp" as ts, 0 as rk, event_id, event_id as lid, null as rid, null as pid from loc
  union all select client_mac, namespace_uuid, "timestamp", 0, event_id, null, event_id, null from rad
  union all select client_mac, namespace_uuid, "timestamp", 0, event_id, null, null, event_id from pms
  union all select client_mac, namespace_uuid, "timestamp", 1, event_id, null, null, null from fx_flow),
 lately as (select *, last_value(lid ignore nulls) over w as last_l, last_value(rid ignore nulls) over w as last_r, last_value(pid ignore nulls) over w as last_p
  from moves window w as (partition by client_mac, namespace_uuid order by ts, rk, event_id {RUNNING})),
 every_state as (select s.event_id, s.client_rssi_num, coalesce(l.station, i_station, m_station) as wireless_station, coalesce(i_ssid, m_ssid, r.ssid) as wireless_id,
   coalesce(l.status, case when coalesce(measure_id, info_id) is not null then 'ASSOCIATED' end) as dot11_status, l.campus, coalesce(l.building, p.building) as building,
   r.client_id, g.name as client_fullname
  from seen s join lately u on u.event_id = s.event_id and u.rk = 1 left join loc l on l.event_id = u.last_l left join rad r on r.event_id = u.last_r
  left join pms g on g.event_id = u.last_p left join places p on p.wireless_station = coalesce(l.station, i_station, m_station))"""
STATE_COLUMNS = ["client_rssi_num", "wireless_station", "wireless_id", "dot11_status", "campus", "building", "client_id", "client_fullname"]


def learned(flows: DataFrame, nmsp_rows: DataFrame, carried: dict[str, DataFrame] | None = None) -> list[DataFrame]:
    """States of all six feeds, most of them made from flow records."""
    i = F.col("event_id")
    place = F.to_json(F.struct(
        F.col("client_mac").alias("macAddress"), F.when(i % 2 == 1, "ASSOCIATED").otherwise("PROBING").alias("dot11Status"),
        F.when(i % 2 == 1, F.concat(F.lit("lap-"), (i % 5).cast("string"))).alias("apMacAddress"),
        F.struct(F.concat(F.lit("C"), (i % 3).cast("string"), F.lit(">B"), (i % 4).cast("string")).alias("mapHierarchyString")).alias("MapInfo"),
        F.struct(F.lit(1.5).alias("lattitude"), F.lit(2.5).alias("longitude")).alias("GeoCoordinate")))
    stamp = F.concat(F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))
    located = flows.filter(i % 7 == 1).select("event_id", "namespace_uuid", F.struct(stamp.alias("timestamp"), place.alias("location")).alias("StreamingNotification"))
    clouds = flows.filter(i % 7 == 4).select(
        "event_id", "timestamp", "client_mac", "namespace_uuid", F.when(i % 3 == 0, "10.0.0.1").alias("src"), F.concat(F.lit("cloud-"), (i % 2).cast("string")).alias("wireless_station"))
    accounted = flows.filter(i % 11 == 2).select(
        "event_id", "timestamp", "namespace_uuid", F.col("client_mac").alias("Calling-Station-Id"), F.lit("Start").alias("Acct-Status-Type"),
        F.concat(F.lit("u-"), i.cast("string")).alias("User-Name"), F.lit("net").alias("Airespace-Wlan_Id"))
    guests = flows.filter(i % 13 == 3).select("event_id", "timestamp", "client_mac", "namespace_uuid", F.concat(F.lit("g-"), i.cast("string")).alias("guest_name"))
    return learned_states(nmsp_rows, located, clouds, accounted, guests, carried=carried)


def chain(spark: SparkSession) -> list:
    """Learned states with a table between them; radius fills gaps only, and comes after the table."""
    return [LearnedStore("nmsp-measure"), LearnedStore("nmsp-info"), LearnedStore("location"),
            StoreSpec("places", places(spark), keys=("wireless_station",), overwrite=False), LearnedStore("radius", overwrite=False), LearnedStore("pms")]


def every_store(spark: SparkSession, sf: str) -> Context:
    nmsp_rows = view(spark, sf, "fx_nmsp")
    return Context(states=learned(view(spark, sf, "fx_flow"), nmsp_rows), stores=chain(spark))


@query("flow_all_states", oracle("""
select s.event_id, s.st as "timestamp", s.bytes, client_rssi_num, wireless_station, wireless_id, dot11_status, campus, building, client_id, client_fullname
from slices s join every_state e on e.event_id = s.event_id""", SRC_PLAIN + "," + SLICES + "," + ALL_SEEN))
def flow_all_states(spark: SparkSession, sf: str) -> DataFrame:
    out, = run_topic(view(spark, sf, "fx_flow"), fields.FLOW, every_store(spark, sf))
    return out.select("event_id", "timestamp", "bytes", *STATE_COLUMNS)


@query("event_all_states", oracle("""
select event_id, client_rssi_num, wireless_station, wireless_id, dot11_status, campus, building, client_id, client_fullname from every_state""", ALL_SEEN))
def event_all_states(spark: SparkSession, sf: str) -> DataFrame:
    out, = run_topic(view(spark, sf, "fx_flow"), fields.EVENT, every_store(spark, sf))
    return out.select("event_id", *STATE_COLUMNS)
