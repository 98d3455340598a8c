"""Flow, scalar-function and lookup queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import address, text
from flowloom.operators import hierarchy, lookup, privacy, ranges, records, rollup
from flowloom.operators.counters import datasource_name
from flowloom.operators.lookup import StoreSpec
from flowloom.operators.split import split_flows
from workload.catalog import query
from workload.near import compare, near_exact, near_sql
from workload.views import oracle, view

# ---------------------------------------------------------------- flows

EDGE_TIMES = """
 case when event_id % 17 = 0 then null else "timestamp" end as ts0,
 case when event_id % 11 = 0 then null when event_id % 13 = 0 then "timestamp" + 5 else first_switched end as fs0"""


def edge_times(df: DataFrame) -> DataFrame:
    """Flows with some missing and some reversed times."""
    i = F.col("event_id")
    return df.withColumns({
        "first_switched": F.when(i % 11 == 0, None).when(i % 13 == 0, F.col("timestamp") + 5).otherwise(F.col("first_switched")),
        "timestamp": F.when(i % 17 == 0, None).otherwise(F.col("timestamp")),
    })


@query("flow_duration", oracle(f"""
select event_id, cast(case when coalesce(ts0, arrival) - coalesce(fs0, coalesce(ts0, arrival)) < 0 then 1
  else coalesce(ts0, arrival) - coalesce(fs0, coalesce(ts0, arrival)) end as bigint) as duration
from (select event_id, arrival, {EDGE_TIMES} from fx_flow) t"""))
def flow_duration(spark: SparkSession, sf: str) -> DataFrame:
    df = edge_times(view(spark, sf, "fx_flow"))
    return df.select("event_id", text.flow_duration(F.col("timestamp"), F.col("first_switched"), F.col("arrival")).alias("duration"))


# Slices from first principles: cut points listed, shares by length, remainder on the last slice.
SLICES = """
sl_base as (select *, ts0 is not null and fs0 is not null as timed, arrival as n,
   (arrival % 3600) // 60 as mi from src),
sl_a as (select *, n - n % 3600 + n % 60 - case when mi < 15 then 3600 else 0 end as lim,
   (((ts0 % 86400) // 3600 = (n % 86400) // 3600 - 1 and mi > 15) or n - ts0 > 3600) as stale from sl_base),
sl_b as (select *, case when not stale and fs0 < lim then lim else fs0 end as s1 from sl_a),
sl_c as (select *, ts0 > n and ((ts0 % 86400) // 3600 <> (s1 % 86400) // 3600 or ts0 - n > 3600) as fut from sl_b),
sl_d as (select *, case when fut then n else ts0 end as e, case when fut and n <= s1 then n else s1 end as s from sl_c),
sl_cut as (select *, unnest(case when timed then list_prepend(s, list_filter(
   case when e > s then generate_series(s - s % 60 + 60, e, 60) else [] end, lambda x: x < e)) else [coalesce(ts0, n)] end) as st from sl_d),
sl_len as (select *, coalesce(lead(st) over w, e) - st as len, row_number() over w as k,
   count(*) over (partition by event_id) as cnt from sl_cut window w as (partition by event_id order by st)),
sl_share as (select *, case when not timed then bytes when e = s then bytes else cast(cast(bytes as hugeint) * len // (e - s) as bigint) end as bs,
   case when not timed then pkts when e = s then pkts else cast(cast(pkts as hugeint) * len // (e - s) as bigint) end as ps from sl_len),
slices as (select event_id, st, k, duration, application_id_name, client_mac, namespace_uuid,
   case when k = cnt and bs + bytes - sum(bs) over (partition by event_id) > 0 then cast(bs + bytes - sum(bs) over (partition by event_id) as bigint) else bs end as bytes,
   case when k = cnt and ps + pkts - sum(ps) over (partition by event_id) > 0 then cast(ps + pkts - sum(ps) over (partition by event_id) as bigint) else ps end as pkts
   from sl_share)"""

SRC_EDGE = f"""
src as (select *, cast(case when coalesce(ts0, arrival) - coalesce(fs0, coalesce(ts0, arrival)) < 0 then 1
   else coalesce(ts0, arrival) - coalesce(fs0, coalesce(ts0, arrival)) end as bigint) as duration
   from (select *, {EDGE_TIMES} from fx_flow) t)"""
SRC_PLAIN = """
src as (select *, "timestamp" as ts0, first_switched as fs0, "timestamp" - first_switched as duration from fx_flow)"""


@query("flow_split", oracle("""
select event_id, st as "timestamp", bytes, pkts, case when k = 1 then duration end as duration from slices""", SRC_EDGE + "," + SLICES))
def flow_split(spark: SparkSession, sf: str) -> DataFrame:
    df = edge_times(view(spark, sf, "fx_flow"))
    df = df.withColumn("duration", text.flow_duration(F.col("timestamp"), F.col("first_switched"), F.col("arrival")))
    return split_flows(df, "arrival").select("event_id", "timestamp", "bytes", "pkts", "duration")


FLOW_SMALL = replace(rollup.FLOW, dims=("application_id_name",))


FLOW_ROLLUP_SQL = oracle("""
select st - st % 60 as "timestamp", case when namespace_uuid is null then 'rb_flow' else 'rb_flow_' || namespace_uuid end as datasource,
  application_id_name, count(*) as events, cast(sum(bytes) as bigint) as sum_bytes, cast(sum(pkts) as bigint) as sum_pkts,
  cast(0 as bigint) as sum_rssi, count(distinct client_mac) as clients, cast(0 as bigint) as wireless_stations from slices group by all""", SRC_PLAIN + "," + SLICES)


def split_and_named(spark: SparkSession, sf: str) -> DataFrame:
    flows = records.flow(view(spark, sf, "fx_flow"), now="arrival")
    return flows.withColumn("datasource", datasource_name("rb_flow", F.col("namespace_uuid")))


@query("flow_rollup", FLOW_ROLLUP_SQL)
def flow_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.rollup(split_and_named(spark, sf), FLOW_SMALL, mode="exact", extra_dims=("datasource",))


@query("flow_rollup_approx", near_sql(FLOW_ROLLUP_SQL, FLOW_SMALL))
def flow_rollup_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The exact rollup and, for each distinct count, whether the estimate is near it."""
    return near_exact(split_and_named(spark, sf), FLOW_SMALL, ("datasource",))


@query("flow_rollup_merged", oracle("""
select st - st % 3600 as "timestamp", application_id_name, count(*) as events, cast(sum(bytes) as bigint) as sum_bytes, cast(sum(pkts) as bigint) as sum_pkts,
  count(distinct client_mac) as clients, true as clients_near from slices group by 1, 2""", SRC_PLAIN + "," + SLICES))
def flow_rollup_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly clients and bytes from minute rollups that keep sketches, against exact hours."""
    flows = split_and_named(spark, sf)
    merged = rollup.merge_rollups(rollup.rollup(flows, FLOW_SMALL, mode="sketch"), FLOW_SMALL, ["application_id_name"])
    hour = (F.col("timestamp") - F.col("timestamp") % 3600).alias("timestamp")
    exact = flows.groupBy(hour, "application_id_name").agg(
        F.count("*").alias("events"), F.sum("bytes").alias("sum_bytes"), F.sum("pkts").alias("sum_pkts"), F.count_distinct("client_mac").alias("clients"))
    both = compare(exact.drop("events", "sum_bytes", "sum_pkts"), merged, ["timestamp", "application_id_name"], ["clients"])
    # the sums are those of the merged sketches' rows
    return merged.select("timestamp", "application_id_name", "events", "sum_bytes", "sum_pkts").join(both, ["timestamp", "application_id_name"])


# ---------------------------------------------------------------- scalar functions

LABEL = "case when {0} = 0 then 'unknown' when {0} <= -85 then 'bad' when {0} <= -80 then 'low' when {0} <= -70 then 'medium' when {0} <= -60 then 'good' when {0} is not null then '{1}' end"
PROFILE = "case when {0} = 0 then 'hard' when {0} <= -75 then 'soft' when {0} <= -65 then 'medium' when {0} is not null then 'hard' end"
READING = "cast(case when event_id % 101 = 100 then null else -(event_id % 101) end as int)"


def readings(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    return view(spark, sf, "events").select("event_id", F.when(i % 101 != 100, -(i % 101)).cast("int").alias("rssi"))


@query("rssi_labels", f"""
select event_id, {LABEL.format('rssi', 'excellent')} as label, {LABEL.format('rssi', 'excelent')} as cloud_label
from (select event_id, {READING} as rssi from events) t""")
def rssi_labels(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("rssi")
    return readings(spark, sf).select(
        "event_id", text.rssi_label(r).alias("label"), text.rssi_label(r, text.RSSI_TOP_CLOUD).alias("cloud_label"))


@query("client_profile", f"select event_id, {PROFILE.format('rssi')} as profile from (select event_id, {READING} as rssi from events) t")
def client_profile(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).select("event_id", text.client_profile(F.col("rssi")).alias("profile"))


@query("strongest_ap", oracle("""
select event_id, case when rssi[1] >= rssi[2] then ap_mac[1] else ap_mac[2] end as ap, greatest(rssi[1], rssi[2]) as rssi from fx_nmsp"""))
def strongest_ap(spark: SparkSession, sf: str) -> DataFrame:
    best = text.strongest_ap(F.col("ap_mac"), F.col("rssi"))
    return view(spark, sf, "fx_nmsp").select("event_id", best.alias("b")).select("event_id", "b.ap", "b.rssi")


@query("zone_path", oracle("""
select event_id, p[1] as campus, p[2] as building, p[3] as floor, p[4] as zone
from (select event_id, string_split(location_map_hierarchy, '>') as p from fx_location10) t"""))
def zone_path(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_location10").select("event_id", text.zone_path(F.col("location_map_hierarchy")).alias("z")).select("event_id", "z.*")


@query("latlng_round", oracle("""
select id, floor(latitude * 100000 + 0.5) / 100000 as lat, floor(longitude * 100000 + 0.5) / 100000 as lon from fx_aps"""))
def latlng_round(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split(text.latlng(F.col("latitude"), F.col("longitude")), ",")
    return view(spark, sf, "fx_aps").select("id", parts[0].cast("double").alias("lat"), parts[1].cast("double").alias("lon"))


CALLED = r"regexp_matches(called_station_id, '^([0-9a-fA-F]{2}[:-]){5}[0-9a-fA-F]{2}[:-]')"


@query("station_parse", oracle(f"""
select id, case when {CALLED} then replace(lower(left(called_station_id, 17)), '-', ':') end as station,
  case when {CALLED} then substr(called_station_id, 19) end as ssid from fx_radius"""))
def station_parse(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_radius").select("id", address.station_parse(F.col("called_station_id")).alias("s")).select("id", "s.*")


@query("mac_normalise", oracle("""
select id, replace(lower(calling_station_id), '-', ':') as mac, upper(left(replace(calling_station_id, '-', ''), 6)) as oui from fx_radius"""))
def mac_normalise(spark: SparkSession, sf: str) -> DataFrame:
    mac = F.col("calling_station_id")
    return view(spark, sf, "fx_radius").select("id", address.mac_norm(mac).alias("mac"), address.oui(mac).alias("oui"))


STATUS_SQL = "case status " + " ".join(f"when {k} then '{v}'" for k, v in text.STATUS_NAMES.items()) + " end"


@query("status_names", oracle(f"select event_id, {STATUS_SQL} as status_name from fx_location10"))
def status_names(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_location10").select("event_id", text.status_name(F.col("status")).alias("status_name"))


@query("as_name_parse", oracle("""
select start_ip, case when instr(as_info, ' ') > 0 then substr(as_info, instr(as_info, ' ') + 1) else as_info end as as_name from fx_geo"""))
def as_name_parse(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_geo").select("start_ip", text.as_name(F.col("as_info")).alias("as_name"))


V4_NUM = "cast({0}[1] as bigint) * 16777216 + cast({0}[2] as bigint) * 65536 + cast({0}[3] as bigint) * 256 + cast({0}[4] as bigint)"


@query("ip_family", oracle(f"""
select event_id, family, case when family = 4 then '4' || lower(lpad(to_hex({V4_NUM.format('p')}), 8, '0')) else '6' || replace(wan_ip, ':', '') end as ip_key
from (select event_id, wan_ip, cast(case when instr(wan_ip, ':') > 0 then 6 else 4 end as int) as family,
  case when instr(wan_ip, ':') > 0 then ['0','0','0','0'] else string_split(wan_ip, '.') end as p from fx_flow) t"""))
def ip_family(spark: SparkSession, sf: str) -> DataFrame:
    ip = F.col("wan_ip")
    return view(spark, sf, "fx_flow").select("event_id", address.ip_family(ip).alias("family"), address.ip_key(ip).alias("ip_key"))


# ---------------------------------------------------------------- lookups

VENDORS = "select * from (values ('001CB3', 'Apple'), ('00AABB', 'Acme')) t(oui, vendor)"


def vendors(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values ('001CB3', 'Apple'), ('00AABB', 'Acme') as t(oui, vendor)")


@query("vendor_lookup", oracle(f"""
select event_id, client_mac, vendor as client_mac_vendor from fx_flow
left join ({VENDORS}) v on v.oui = upper(left(replace(replace(client_mac, '-', ''), ':', ''), 6))"""))
def vendor_lookup(spark: SparkSession, sf: str) -> DataFrame:
    out = lookup.vendor_lookup(view(spark, sf, "fx_flow"), vendors(spark))
    return out.select("event_id", "client_mac", "client_mac_vendor")


@query("threat_lookup", oracle("""
select event_id, case when s.ip is not null and d.ip is not null then 'both' when s.ip is not null then 'source' when d.ip is not null then 'destination' else 'clean' end as darklist_direction,
  case when s.ip is null and d.ip is null then 'clean' when d.ip is null or s.darklist_score > d.darklist_score then s.darklist_category else d.darklist_category end as darklist_category,
  case when s.ip is null and d.ip is null then null when d.ip is null or s.darklist_score > d.darklist_score then s.darklist_score else d.darklist_score end as darklist_score
from fx_flow f left join fx_threat s on s.ip = f.lan_ip left join fx_threat d on d.ip = f.wan_ip"""))
def threat_lookup(spark: SparkSession, sf: str) -> DataFrame:
    flows = view(spark, sf, "fx_flow").select("event_id", F.col("lan_ip").alias("src"), F.col("wan_ip").alias("dst"))
    out = lookup.threat_lookup(flows, view(spark, sf, "fx_threat"))
    return out.select("event_id", "darklist_direction", "darklist_category", "darklist_score")


PROFILES = "select client_mac, namespace_uuid, max(wireless_station) as wireless_station, max(wireless_id) as wireless_id from fx_nmsp group by 1, 2"
PLACES = "select wireless_station, 'b-' || wireless_station as building, 'f-' || min(vlan_id) as floor from fx_nmsp where wireless_station <> 'ap-5' group by 1"


@query("store_chain", oracle("""
select f.event_id, p.wireless_station, coalesce(p.wireless_id, case when event_id % 3 = 0 then 'own-ssid' end) as wireless_id,
  coalesce(case when event_id % 4 = 0 then 'own-b' end, a.building) as building, a.floor
from fx_flow f left join profiles p on p.client_mac is not distinct from f.client_mac and p.namespace_uuid is not distinct from f.namespace_uuid
left join places a on a.wireless_station = p.wireless_station""", f"profiles as ({PROFILES}), places as ({PLACES})"))
def store_chain(spark: SparkSession, sf: str) -> DataFrame:
    flows = view(spark, sf, "fx_flow").withColumns({
        "wireless_id": F.when(F.col("event_id") % 3 == 0, "own-ssid"), "building": F.when(F.col("event_id") % 4 == 0, "own-b")})
    view(spark, sf, "fx_nmsp")
    out = lookup.lookup_chain(flows, [
        StoreSpec("clients", spark.sql(PROFILES)),
        StoreSpec("places", spark.sql(PLACES), keys=("wireless_station",), overwrite=False),
    ])
    return out.select("event_id", "wireless_station", "wireless_id", "building", "floor")


GUARDED = """(values ('ap-0', 'z0', 'ns-1', 'full-0'), ('ap-1', 'z1', cast(null as varchar(9)), 'full-1'), ('ap-2', 'z2', 'ns-2', 'full-2'),
  ('ap-0', cast(null as varchar(9)), 'ns-2', 'short-0'), ('ap-1', cast(null as varchar(9)), cast(null as varchar(9)), 'short-1'), ('ap-3', cast(null as varchar(9)), 'ns-3', 'short-3'))"""


@query("namespace_guard", oracle(f"""
select event_id, case when hit_ns is null or own_ns is null or hit_ns = own_ns then hit_place end as place,
  coalesce(case when hit_ns is null or own_ns is null or hit_ns = own_ns then hit_ns end, own_ns) as namespace_uuid
from (select f.event_id, f.namespace_uuid as own_ns, case when g.place is not null then g.ns else h.ns end as hit_ns, coalesce(g.place, h.place) as hit_place
  from (select *, 'ap-' || cast(event_id % 5 as varchar) as ap, case when event_id % 7 = 0 then null else 'z' || cast(event_id % 3 as varchar) end as zone from fx_flow) f
  left join guarded g on g.ap = f.ap and g.zone is not distinct from f.zone
  left join guarded h on h.ap = f.ap and h.zone is null) t""", f"guarded as (select * from {GUARDED} t(ap, zone, ns, place))"))
def namespace_guard(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    flows = view(spark, sf, "fx_flow").withColumns({
        "wireless_station": F.concat(F.lit("ap-"), (i % 5).cast("string")),
        "zone_uuid": F.when(i % 7 != 0, F.concat(F.lit("z"), (i % 3).cast("string")))})
    table = spark.sql(f"select * from {GUARDED[1:-1]} as t(wireless_station, zone_uuid, namespace_uuid, place)")
    out = lookup.lookup_chain(flows, [
        StoreSpec("sensor", table, keys=("wireless_station", "zone_uuid"), guard_namespace=True)])
    return out.select("event_id", "place", "namespace_uuid")


def geo_body(columns: str) -> str:
    hit = lambda side: f"""left join fx_geo {side[0]} on {side}_n between {side[0]}.start_ip and {side[0]}.end_ip"""
    num = lambda c: f"case when instr({c}, ':') > 0 then null else " + V4_NUM.format(f"string_split(case when instr({c}, ':') > 0 then '0.0.0.0' else {c} end, '.')") + " end"
    name = lambda t: f"case when instr({t}.as_info, ' ') > 0 then substr({t}.as_info, instr({t}.as_info, ' ') + 1) else {t}.as_info end"
    return f"""select event_id, {columns} from (select f.event_id, lan_ip, wan_ip, l.country_code as lan_cc, w.country_code as wan_cc,
      {name('l')} as lan_as, {name('w')} as wan_as
      from (select *, {num('lan_ip')} as lan_n, {num('wan_ip')} as wan_n from fx_flow) f {hit('lan')} {hit('wan')}) t"""


@query("enricher_chain", oracle(f"""
select f.event_id, coalesce(own, vendor) as client_mac_vendor, g.lan_cc as lan_ip_country_code, g.wan_cc as wan_ip_country_code
from (select *, case when event_id % 9 = 0 then 'own-vendor' end as own from fx_flow) f join ({geo_body("lan_cc, wan_cc")}) g on g.event_id = f.event_id
left join ({VENDORS}) v on v.oui = upper(left(replace(replace(client_mac, '-', ''), ':', ''), 6))"""))
def enricher_chain(spark: SparkSession, sf: str) -> DataFrame:
    """A vendor hit may not replace a vendor already on the record, because it is not the last enricher."""
    flows = view(spark, sf, "fx_flow").withColumn("client_mac_vendor", F.when(F.col("event_id") % 9 == 0, "own-vendor"))
    out = lookup.enrich_chain(flows, [lookup.vendor_enricher(vendors(spark)), ranges.geo_enricher(view(spark, sf, "fx_geo"), None)])
    return out.select("event_id", "client_mac_vendor", "lan_ip_country_code", "wan_ip_country_code")


def geo_sql(columns: str) -> str:
    return oracle(geo_body(columns))


@query("geoip_country", geo_sql("""lan_cc as lan_ip_country_code, wan_cc as wan_ip_country_code, coalesce(wan_cc, lan_cc) as ip_country_code,
  case when wan_cc is not null then wan_ip when lan_cc is not null then lan_ip end as public_ip"""))
def geoip_country(spark: SparkSession, sf: str) -> DataFrame:
    out = ranges.geo_lookup(view(spark, sf, "fx_flow"), view(spark, sf, "fx_geo"), None)
    return out.select("event_id", "lan_ip_country_code", "wan_ip_country_code", "ip_country_code", "public_ip")


@query("geoip_asn", geo_sql("lan_as as lan_ip_as_name, wan_as as wan_ip_as_name, coalesce(wan_as, lan_as) as ip_as_name"))
def geoip_asn(spark: SparkSession, sf: str) -> DataFrame:
    out = ranges.geo_lookup(view(spark, sf, "fx_flow"), None, view(spark, sf, "fx_geo"))
    return out.select("event_id", "lan_ip_as_name", "wan_ip_as_name", "ip_as_name")


SALTS = "(values ('sp-0', '6A285A12B390A55E021EB983B20D5F4E'), ('sp-1', '00112233445566778899AABBCCDDEEFF'))"


def salts(spark: SparkSession) -> DataFrame:
    return spark.sql(f"select * from {SALTS[1:-1]} as t(uuid, salt)")


# PBKDF2-HMAC-SHA256 spelled out for DuckDB: u1 = HMAC(pw, salt || 1), u(i+1) = HMAC(pw, u(i)), 48-bit XOR of all.
def _pbkdf2_sql() -> str:
    pad = lambda byte: f"unhex(list_aggregate(list_transform(range(0, 64), lambda i: printf('%02x', xor(cast(coalesce(list_extract(pw, i + 1), 0) as integer), {byte}))), 'string_agg', ''))"
    pw = "list_transform(range(0, length(pw_hex) // 2), lambda i: cast('0x' || substr(pw_hex, i * 2 + 1, 2) as integer))"
    mac = lambda msg: f"unhex(sha256(opad || unhex(sha256(ipad || {msg}))))"
    first6 = lambda u: f"cast('0x' || substr(hex({u}), 1, 12) as bigint)"
    return f"""
distinct_macs as (select distinct s.salt, replace(client_mac, ':', '') as mac from fx_flow f join salts s on s.uuid = f.service_provider_uuid where instr(client_mac, '-') = 0),
pws as (select salt, mac, {pw} as pw from (select *, lower(hex(encode('{privacy.PREFIX}'))) || mac as pw_hex from distinct_macs) t),
pads as (select salt, mac, {pad(0x36)} as ipad, {pad(0x5c)} as opad from pws),
rounds as (select salt, mac, ipad, opad, 1 as i, {mac("(unhex(salt) || unhex('00000001'))")} as u, {first6(mac("(unhex(salt) || unhex('00000001'))"))} as x from pads
  union all select salt, mac, ipad, opad, i + 1, {mac('u')}, xor(x, {first6(mac('u'))}) from rounds where i < {privacy.ITERATIONS}),
keys as (select salt, mac, lower(printf('%012x', x)) as k from rounds where i = {privacy.ITERATIONS})"""


@query("mac_scramble", oracle("""
select event_id, coalesce(substr(k, 1, 2) || ':' || substr(k, 3, 2) || ':' || substr(k, 5, 2) || ':' || substr(k, 7, 2) || ':' || substr(k, 9, 2) || ':' || substr(k, 11, 2), client_mac) as client_mac
from fx_flow f left join salts s on s.uuid = f.service_provider_uuid left join keys k on k.salt = s.salt and k.mac = replace(f.client_mac, ':', '')""",
    f"salts as (select * from {SALTS} t(uuid, salt))," + _pbkdf2_sql()))
def mac_scramble(spark: SparkSession, sf: str) -> DataFrame:
    return privacy.scramble_macs(view(spark, sf, "fx_flow"), salts(spark)).select("event_id", "client_mac")


# ---------------------------------------------------------------- site tables

LEVEL_JOINS = " ".join(
    f"left join (select * from fx_sensors where domain_type = {code}) {name} on {name}.lft <= s.lft and {name}.rgt >= s.rgt"
    for name, code in hierarchy.LEVELS.items())
LEVEL_COLS = ", ".join(f"{n}.name as {n}, {n}.uuid as {n}_uuid, {n}.id as {n}_id" for n in hierarchy.LEVELS)
ZONES = "select n_nationkey as id, n_name as name from nation"
BRIDGE = "select p_partkey as access_point_id, cast(p_partkey % 30 as int) as zone_id from part where p_partkey % 3 <> 0"


@query("site_dimension", oracle(f"""
select mac_address, {', '.join(f'{n}, {n}_uuid' for n in hierarchy.LEVELS)}, zone, cast(zone_uuid as varchar) as zone_uuid,
  floor(latitude * 100000 + 0.5) / 100000 as lat, floor(longitude * 100000 + 0.5) / 100000 as lon
from (select a.mac_address, a.latitude, a.longitude, {LEVEL_COLS}, z.name as zone, z.id as zone_uuid,
  row_number() over (partition by a.mac_address order by a.id, z.id nulls last, {', '.join(f'{n}.id' for n in hierarchy.LEVELS)}) as rn
  from fx_aps a join fx_sensors s on a.sensor_id = s.id
  left join ({BRIDGE}) b on b.access_point_id = a.id left join ({ZONES}) z on z.id = b.zone_id {LEVEL_JOINS}) t where rn = 1"""))
def site_dimension(spark: SparkSession, sf: str) -> DataFrame:
    for table in ("nation", "part"):
        view(spark, sf, table).createOrReplaceTempView(table)
    zones, bridge = spark.sql(ZONES), spark.sql(BRIDGE)
    out = hierarchy.site_dimension(view(spark, sf, "fx_aps"), view(spark, sf, "fx_sensors"), zones, bridge)
    parts = F.split("client_latlong", ",")
    return out.select(
        "mac_address", *[c for n in hierarchy.LEVELS for c in (n, f"{n}_uuid")], "zone", "zone_uuid",
        parts[0].cast("double").alias("lat"), parts[1].cast("double").alias("lon"))


POSITIONS = """select uuid, domain_type, case when id % 3 = 0 then cast(id as {s}) when id % 3 = 1 then '37.39' else null end as latitude,
 case when id % 4 = 0 then null else cast(lft as {s}) end as longitude,
 case when id % 2 = 1 then '{{"mac_hashing_salt":"' || uuid || '-salt"}}' else '{{"other":1}}' end as property from fx_sensors"""


def positioned(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "fx_sensors")
    return spark.sql(POSITIONS.format(s="string"))


@query("sensor_locations", oracle("""
select uuid as sensor_uuid, cast(latitude as double) as lat, cast(longitude as double) as lon from pos
where latitude is not null and longitude is not null and instr(latitude, '.') = 0""", f"pos as ({POSITIONS.format(s='varchar')})"))
def sensor_locations(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("client_latlong", ",")
    return hierarchy.sensor_locations(positioned(spark, sf)).select(
        "sensor_uuid", parts[0].cast("double").alias("lat"), parts[1].cast("double").alias("lon"))


@query("provider_salts", oracle("""
select uuid, uuid || '-salt' as salt from pos where domain_type in (2, 6) and instr(property, 'mac_hashing_salt') > 0""", f"pos as ({POSITIONS.format(s='varchar')})"))
def provider_salts(spark: SparkSession, sf: str) -> DataFrame:
    rows = positioned(spark, sf).withColumn("domain_type", F.when(F.col("domain_type") == 2, 6).otherwise(F.col("domain_type")))
    return hierarchy.provider_salts(rows)


@query("snapshot_delta", oracle("""
select coalesce(o.id, n.id) as id, case when o.id is null then 'added' when n.id is null then 'removed' else 'changed' end as change
from (select * from fx_aps where id % 5 <> 0) o full join (select id, mac_address, case when id % 4 = 0 then latitude + 1 else latitude end as latitude from fx_aps where id % 7 <> 0) n on o.id = n.id
where o.id is null or n.id is null or o.latitude is distinct from n.latitude"""))
def snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    aps = view(spark, sf, "fx_aps").select("id", "mac_address", "latitude")
    old = aps.filter("id % 5 <> 0")
    new = aps.filter("id % 7 <> 0").withColumn("latitude", F.when(F.col("id") % 4 == 0, F.col("latitude") + 1).otherwise(F.col("latitude")))
    return hierarchy.snapshot_delta(old, new, ["id"])
