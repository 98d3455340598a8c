"""Client-state queries: associations, locations, accounting, profiles, as-of enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.text import STATUS_NAMES
from flowloom.operators import asof, location, nmsp, records
from flowloom.operators.counters import datasource_name
from flowloom.operators.lookup import StoreSpec, enrich_record, lookup_chain
from workload.catalog import query
from workload.scalar import CALLED, LABEL, PROFILE
from workload.views import oracle, view

# ---------------------------------------------------------------- associations and signals

RUNNING = "rows between unbounded preceding and current row"
INFO = """info as (select event_id, client_mac, namespace_uuid, "timestamp", wireless_station, wireless_id, vlan_id as lan_vlan, "timestamp" as last_seen from fx_nmsp where type = 'info')"""
JUDGED = INFO + """,
 both_kinds as (select client_mac, namespace_uuid, "timestamp" as ts, 0 as rk, event_id, wireless_station as st, wireless_id as wid, lan_vlan as lv, last_seen as seen, event_id as iid from info
  union all select client_mac, namespace_uuid, "timestamp", 1, event_id, null, null, null, null, null from fx_nmsp where type = 'measure'),
 known as (select *, last_value(iid ignore nulls) over (partition by client_mac, namespace_uuid order by ts, rk, event_id """ + RUNNING + """) as last_iid from both_kinds),
 paired as (select m.event_id, m."timestamp", m.client_mac, m.namespace_uuid, m.ap_mac, m.rssi, i.event_id as iid, i.wireless_station as st, i.wireless_id as wid, i.lan_vlan as lv, i.last_seen as seen
  from fx_nmsp m join known k on k.event_id = m.event_id and k.rk = 1 left join info i on i.event_id = k.last_iid where m.type = 'measure'),
 decided as (select *, iid is not null and seen + 3600 > "timestamp" as fresh, list_contains(ap_mac, st) as heard from paired),
 judged as (select event_id, "timestamp", client_mac, namespace_uuid, iid, fresh as joined, iid is not null and not fresh as stale,
  case when fresh then rssi[list_position(ap_mac, st)] else greatest(rssi[1], rssi[2]) end as client_rssi_num,
  case when fresh then st when rssi[1] >= rssi[2] then ap_mac[1] else ap_mac[2] end as wireless_station,
  case when fresh then wid end as wireless_id, case when fresh then lv end as lan_vlan, case when fresh then seen end as last_seen
  from decided where not fresh or heard)"""


def signals(spark: SparkSession, sf: str) -> DataFrame:
    """The signal view with the radio fields that an association carries."""
    return with_radio(view(spark, sf, "fx_nmsp"))


def with_radio(df: DataFrame) -> DataFrame:
    return df.withColumns({"wireless_channel": F.concat(F.lit("ch-"), (F.col("event_id") % 11).cast("string")), "dot11_protocol": F.lit("802.11n")})


#: the radio fields of the association that a measure was joined to
RADIO = "case when joined then 'ch-' || (iid % 11) end as wireless_channel, case when joined then '802.11n' end as dot11_protocol"


@query("nmsp_info", oracle("""
select event_id, "timestamp", 'nmsp-info' as type, client_mac, namespace_uuid, wireless_station, wireless_id, lan_vlan, last_seen,
  'ASSOCIATED' as dot11_status, 'hard' as client_profile, 'ch-' || (event_id % 11) as wireless_channel, '802.11n' as dot11_protocol from info""", INFO))
def nmsp_info(spark: SparkSession, sf: str) -> DataFrame:
    return nmsp.nmsp_info(signals(spark, sf))


@query("nmsp_measure", oracle(f"""
select event_id, "timestamp", 'nmsp-measure' as type, client_mac, namespace_uuid, client_rssi_num, wireless_station, wireless_id, lan_vlan, last_seen,
  {LABEL.format('client_rssi_num', 'excellent')} as client_rssi, {PROFILE.format('client_rssi_num')} as client_profile,
  case when joined then 'ASSOCIATED' else 'PROBING' end as dot11_status, {RADIO} from judged where client_rssi_num >= -80 or joined""", JUDGED))
def nmsp_measure(spark: SparkSession, sf: str) -> DataFrame:
    df = signals(spark, sf)
    return nmsp.nmsp_measure(df, nmsp.info_state(nmsp.nmsp_info(df)))


# ---------------------------------------------------------------- locations


def as_notification() -> Column:
    """Columns of the flat view as one element of the feed's list."""
    return F.struct(
        F.col("notification_type").alias("notificationType"), F.col("device_id").alias("deviceId"),
        F.col("ap_mac_address").alias("apMacAddress"), F.col("location_map_hierarchy").alias("locationMapHierarchy"),
        F.col("timestamp_ms").alias("timestamp"), "status", "username", "namespace_uuid",
        F.when(F.col("event_id") % 8 < 5, F.concat(F.lit("ssid-"), (F.col("event_id") % 3).cast("string"))).alias("ssId"), F.lit("IEEE_802_11_B").alias("band"),
        F.concat(F.lit("sub-"), (F.col("event_id") % 4).cast("string")).alias("subscriptionName"),
        F.when(F.col("event_id") % 3 == 0, "m").alias("market"), F.when(F.col("event_id") % 6 == 0, "sn").alias("sensor_name"),
        F.lit("sp").alias("service_provider"))


def notification_lists(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_location10").select("event_id", F.array(as_notification()).alias("notifications"))


STATUS_CASE = "case status " + " ".join(f"when {k} then '{v}'" for k, v in STATUS_NAMES.items()) + " end"
V10 = f"""v10 as (select event_id, timestamp_ms // 1000 as ts, device_id as mac, namespace_uuid as ns, notification_type = 'association' as rs,
  string_split(location_map_hierarchy, '>') as p, ap_mac_address as station, {STATUS_CASE} as st, nullif(username, '') as usr from fx_location10),
 flat as (select *, case when rs then st end as f_status, case when rs then usr end as f_client, case when not rs then p[1] end as f_campus,
  case when not rs then p[2] end as f_building, case when not rs then p[3] end as f_floor, case when not rs then p[4] end as f_zone,
  case when rs and event_id % 8 < 5 then 'ssid-' || (event_id % 3) end as f_ssid, case when rs then 'IEEE_802_11_B' end as f_band from v10),
 grouped as (select *, sum(case when rs then 1 else 0 end) over (partition by mac, ns order by ts, event_id {RUNNING}) as g from flat)"""


def followed_sql(pick: str) -> str:
    field = lambda c: f"{pick}({c} ignore nulls) over (partition by mac, ns, g order by ts, event_id {RUNNING})"
    return oracle(f"""
select event_id, ts as "timestamp", case when rs then 'mse10-association' else 'mse10-location' end as type, mac as client_mac,
  case when not rs then ns end as namespace_uuid, case when g = 0 then 'PROBING' else {field('f_status')} end as dot11_status,
  {field('station')} as wireless_station, {field('f_client')} as client_id, {field('f_campus')} as campus, {field('f_building')} as building, {field('f_floor')} as floor,
  {field('f_zone')} as zone, {field('f_ssid')} as wireless_id, {field('f_band')} as dot11_protocol, cast(null as varchar) as client_latlong, 'sub-' || cast(event_id % 4 as varchar) as "subscriptionName",
  case when rs then 'hard' end as client_profile, case when event_id % 3 = 0 then 'm' end as market,
  case when event_id % 6 = 0 then 'sn' else 'sub-' || cast(event_id % 4 as varchar) end as sensor_name,
  case when not rs then 'sp' end as service_provider from grouped""", V10)


@query("location_v10", followed_sql("first_value"))
def location_v10(spark: SparkSession, sf: str) -> DataFrame:
    return location.location_v10(notification_lists(spark, sf))


@query("location_v10_newest", followed_sql("last_value"))
def location_v10_newest(spark: SparkSession, sf: str) -> DataFrame:
    return location.location_v10(notification_lists(spark, sf), sticky=False)


def streaming_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """The flat version 8/9 view in the nested shape of the feed."""
    loc = F.struct(
        F.col("mac").alias("macAddress"), F.col("ssid").alias("ssId"), F.col("ap").alias("apMacAddress"),
        F.col("status").alias("dot11Status"), F.when(F.col("ip").isNotNull(), F.array("ip")).alias("ipAddress"),
        F.struct(F.col("hierarchy").alias("mapHierarchyString")).alias("MapInfo"),
        F.when(F.col("lat").isNotNull(), F.struct(F.col("lat").alias("lattitude"), F.col("lon").alias("longitude"))).alias("GeoCoordinate"))
    stamp = F.concat(F.date_format(F.timestamp_seconds(F.col("epoch")), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-0700"))
    body = F.struct(
        stamp.alias("timestamp"), F.col("subscription").alias("subscriptionName"),
        F.to_json(loc).alias("location"), F.col("market_in").alias("market"))
    return view(spark, sf, "fx_location89").select(
        "event_id", "namespace_uuid", F.col("market_out").alias("market"), body.alias("StreamingNotification"))


V89 = """v89 as (select event_id, epoch + 25200 as ts, mac, namespace_uuid, string_split(hierarchy, '>') as p, status,
  case when status = 'ASSOCIATED' then ssid end as ssid, case when status = 'ASSOCIATED' then ap end as ap, case when status = 'ASSOCIATED' then ip end as ip,
  floor(lat * 100000 + 0.5) / 100000 as lat, case when lat is not null then floor(lon * 100000 + 0.5) / 100000 end as lon,
  subscription, coalesce(market_out, market_in) as market from fx_location89)"""


@query("location_v89", oracle("""
select event_id, ts as "timestamp", 'mse' as type, mac as client_mac, namespace_uuid, p[1] as campus, p[2] as building, p[3] as floor, status as dot11_status,
  ssid as wireless_id, ap as wireless_station, ip as lan_ip, lat, lon, 'unknown' as client_rssi, 'unknown' as client_snr, 'hard' as client_profile,
  market, subscription as sensor_name from v89""", V89))
def location_v89(spark: SparkSession, sf: str) -> DataFrame:
    out = location.location_v89(streaming_notifications(spark, sf))
    parts = F.split("client_latlong", ",")
    return out.withColumns({"lat": parts[0].cast("double"), "lon": parts[1].cast("double")}).drop("client_latlong")


@query("location_topic", oracle("""
select event_id, ts as "timestamp", 'mse' as type, mac as client_mac, status as dot11_status, p[1] as campus, ap as wireless_station from v89 where event_id % 3 = 0
union all select event_id, ts, type, mac, status, campus, station from mixed where not old""", V89 + "," + V10 + f""",
 both_feeds as (
  select event_id, ts, mac, ns, rs, f_status, f_campus, station, false as old from flat where event_id % 3 <> 0
  union all select event_id, ts, mac, namespace_uuid, true, status, p[1], ap, true from v89 where event_id % 3 = 0),
 both_groups as (select *, sum(case when rs then 1 else 0 end) over (partition by mac, ns order by ts, event_id {RUNNING}) as g2 from both_feeds),
 mixed as (select old, event_id, ts, mac, case when rs then 'mse10-association' else 'mse10-location' end as type,
   case when g2 = 0 then 'PROBING' else first_value(f_status ignore nulls) over w end as status,
   first_value(f_campus ignore nulls) over w as campus, first_value(station ignore nulls) over w as station
  from both_groups window w as (partition by mac, ns, g2 order by ts, event_id {RUNNING}))"""))
def location_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds on one topic: a version 8/9 record resets what later updates remember."""
    old = streaming_notifications(spark, sf).filter("event_id % 3 = 0")
    new = notification_lists(spark, sf).filter("event_id % 3 <> 0")
    out = location.location(old.unionByName(new, allowMissingColumns=True))
    return out.select("event_id", "timestamp", "type", "client_mac", "dot11_status", "campus", "wireless_station")


@query("meraki", oracle(f"""
select event_id, "timestamp", client_mac, namespace_uuid, client_rssi_num, src, wireless_station, client_os,
  case when src is not null then 'ASSOCIATED' else 'PROBING' end as dot11_status, {LABEL.format('client_rssi_num', 'excelent')} as client_rssi,
  {PROFILE.format('client_rssi_num')} as client_profile from fx_meraki where client_mac is not null"""))
def meraki(spark: SparkSession, sf: str) -> DataFrame:
    return location.meraki(view(spark, sf, "fx_meraki"))


# ---------------------------------------------------------------- accounting and profiles


def accounting(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_radius").select(
        "id", F.col("id").alias("event_id"), "timestamp", "namespace_uuid",
        F.col("calling_station_id").alias("Calling-Station-Id"), F.col("called_station_id").alias("Called-Station-Id"),
        F.col("acct_status_type").alias("Acct-Status-Type"), F.col("user_name").alias("User-Name"),
        F.when(F.col("id") % 9 == 0, F.lit("19")).alias("Airespace-Wlan_Id"),
        F.when(F.col("id") % 10 == 0, F.create_map(F.lit("sensor_uuid"), F.col("id").cast("string"), F.lit("colour"), F.lit("red"))).alias("enrichment"),
        F.lit("own-sensor").alias("sensor_uuid"))


@query("radius", oracle(f"""
select id, "timestamp", 'radius' as type, replace(lower(calling_station_id), '-', ':') as client_mac, namespace_uuid, user_name as client_id,
  coalesce(case when {CALLED} then substr(called_station_id, 19) end, case when id % 9 = 0 then '19' end) as wireless_id,
  case when {CALLED} then replace(lower(left(called_station_id, 17)), '-', ':') end as wireless_station,
  lower(acct_status_type) as client_accounting_type, 'hard' as client_profile, case when id % 10 = 0 then cast(id as varchar) else 'own-sensor' end as sensor_uuid,
  case when id % 10 = 0 then 'red' end as colour from fx_radius"""))
def radius(spark: SparkSession, sf: str) -> DataFrame:
    out = records.radius_output(records.radius(accounting(spark, sf)))
    return out.select(
        "id", "timestamp", "type", "client_mac", "namespace_uuid", "client_id", "wireless_id", "wireless_station",
        "client_accounting_type", "client_profile", "sensor_uuid", F.try_element_at("extras", F.lit("colour")).alias("colour"))


@query("pms_profile", oracle("""
select event_id, client_mac, namespace_uuid, coalesce(staff_name, guest_name) as client_fullname, client_gender, auth_type as client_auth_type,
  case when event_id % 9 = 0 then 'vip' end as client_vip, case when event_id % 7 < 3 then 'tier-' || (event_id % 3) end as client_loyality
from fx_pms where coalesce(staff_name, guest_name, client_gender, auth_type) is not null"""))
def pms_profile(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    guests = view(spark, sf, "fx_pms").withColumns({
        "client_vip": F.when(i % 9 == 0, "vip"), "client_loyality": F.when(i % 7 < 3, F.concat(F.lit("tier-"), (i % 3).cast("string")))})
    return records.guest_profiles(guests.filter("coalesce(staff_name, guest_name, client_gender, auth_type) is not null"))


# ---------------------------------------------------------------- as-of enrichment

SEEN = JUDGED + f""",
 steps as (
  select client_mac, namespace_uuid, "timestamp" as ts, 0 as rk, event_id, event_id as mid, null as iid, null as gone from judged
  union all select client_mac, namespace_uuid, "timestamp", 1, event_id, null, event_id, 0 from info
  union all select client_mac, namespace_uuid, "timestamp", 1, event_id, null, event_id, 1 from judged where stale
  union all select client_mac, namespace_uuid, "timestamp", 2, event_id, null, null, null from fx_flow),
 upto as (select *, last_value(mid ignore nulls) over w as last_mid, last_value(iid ignore nulls) over w as last_iid, last_value(gone ignore nulls) over w as last_gone
  from steps window w as (partition by client_mac, namespace_uuid order by ts, rk, event_id {RUNNING})),
 seen as (select f.event_id, m.event_id as measure_id, m.client_rssi_num, m.wireless_station as m_station, m.wireless_id as m_ssid,
   case when u.last_gone = 0 then i.event_id end as info_id, case when u.last_gone = 0 then i.wireless_station end as i_station, case when u.last_gone = 0 then i.wireless_id end as i_ssid,
   case when u.last_gone = 0 then i.lan_vlan end as i_vlan, m.lan_vlan as m_vlan
  from fx_flow f join upto u on u.event_id = f.event_id and u.rk = 2 left join judged m on m.event_id = u.last_mid left join info i on i.event_id = u.last_iid),
 places as (select wireless_station, 'b-' || wireless_station as building from fx_nmsp where wireless_station <> 'ap-5' group by 1)"""


def with_client_states(spark: SparkSession, sf: str, probes: DataFrame) -> DataFrame:
    """Records with the client's signal and association state merged in."""
    df = view(spark, sf, "fx_nmsp")
    info = nmsp.info_state(nmsp.nmsp_info(df))
    judged = nmsp.judge_measures(nmsp.pair_with_info(df, info))
    found = asof.asof_lookup(probes, {}, shared=nmsp.client_history(info, judged), count_on=[probes, df])
    return asof.merge_states(found, {"nmsp-measure": True, "nmsp-info": True})


def places(spark: SparkSession) -> DataFrame:
    return spark.sql("select wireless_station, 'b-' || wireless_station as building from fx_nmsp where wireless_station <> 'ap-5' group by 1")


@query("client_asof_enrich", oracle("""
select event_id, client_rssi_num, coalesce(i_station, m_station) as wireless_station, coalesce(i_ssid, m_ssid) as wireless_id, coalesce(i_vlan, m_vlan) as lan_vlan,
  case when coalesce(measure_id, info_id) is not null then 'ASSOCIATED' end as dot11_status, p.building
from seen left join places p on p.wireless_station = coalesce(i_station, m_station)""", SEEN))
def client_asof_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Flows with the client's signal, then its association, then the place of the station learned from them."""
    out = with_client_states(spark, sf, view(spark, sf, "fx_flow"))
    out = lookup_chain(out, [StoreSpec("places", places(spark), keys=("wireless_station",), overwrite=False)])
    return out.select("event_id", "client_rssi_num", "wireless_station", "wireless_id", "lan_vlan", "dot11_status", "building")


VENDOR_PROFILES = "select client_mac, namespace_uuid, max(application_id_name) as client_os, 'profiled' as client_fullname from fx_flow where event_id % 2 = 0 group by 1, 2"


@query("event_enrich", oracle("""
select f.event_id, f.client_mac, p.client_os, coalesce(p.client_fullname, case when event_id % 5 = 0 then 'own' end) as client_fullname
from fx_flow f left join profiles p on p.client_mac = f.client_mac and p.namespace_uuid is not distinct from f.namespace_uuid""", f"profiles as ({VENDOR_PROFILES})"))
def event_enrich(spark: SparkSession, sf: str) -> DataFrame:
    df = view(spark, sf, "fx_flow").withColumn("client_fullname", F.when(F.col("event_id") % 5 == 0, "own"))
    out = records.event(df, [StoreSpec("profiles", spark.sql(VENDOR_PROFILES))])
    return out.select("event_id", "client_mac", "client_os", "client_fullname")


@query("ap_state_enrich", oracle("""
select m.event_id, m.wireless_station, m.value, p.building, case when namespace_uuid is null then 'rb_state' else 'rb_state_' || namespace_uuid end as datasource
from fx_measure m left join places p on p.wireless_station = m.wireless_station""", "places as (select wireless_station, 'b-' || wireless_station as building from fx_nmsp where wireless_station <> 'ap-5' group by 1)"))
def ap_state_enrich(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "fx_nmsp")
    df = view(spark, sf, "fx_measure").select("event_id", "wireless_station", "value", "namespace_uuid")
    out = records.ap_state(df, [StoreSpec("places", places(spark), keys=("wireless_station",), overwrite=False)])
    return out.select("event_id", "wireless_station", "value", "building", datasource_name("rb_state", F.col("namespace_uuid")).alias("datasource"))


@query("own_fields_win", oracle("""
select m.event_id, coalesce(case when event_id % 2 = 0 then 'own-b' end, p.building) as building, m.wireless_station
from fx_measure m left join places p on p.wireless_station = m.wireless_station""", "places as (select wireless_station, 'b-' || wireless_station as building from fx_nmsp where wireless_station <> 'ap-5' group by 1)"))
def own_fields_win(spark: SparkSession, sf: str) -> DataFrame:
    """Location outputs keep their own fields even against an overwriting store."""
    view(spark, sf, "fx_nmsp")
    df = view(spark, sf, "fx_measure").select("event_id", "wireless_station", F.when(F.col("event_id") % 2 == 0, "own-b").alias("building"))
    out = enrich_record(df, [StoreSpec("places", places(spark), keys=("wireless_station",))], own_wins=True)
    return out.select("event_id", "building", "wireless_station")
