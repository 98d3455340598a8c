"""Input views over the test tables, in Spark SQL; :func:`duck` gives the DuckDB spelling."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

VIEWS = {
    "fx_flow": """
select event_id, unix_timestamp(ts) as `timestamp`, unix_timestamp(ts) - (event_id*37 % 600) as first_switched,
 unix_timestamp(ts) + (event_id*13 % 5400) - 900 as arrival,
 cast(floor(value*1000) as bigint) as bytes, event_id % 97 + 1 as pkts,
 case user_id % 3 when 0 then '00:1c:b3:00:' when 1 then '00-AA-BB-00-' else 'aa:aa:aa:00:' end || lpad(cast(user_id % 100 as string),2,'0') || ':' || lpad(cast(user_id % 7 as string),2,'0') as client_mac,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid,
 'sp-' || cast(user_id % 3 as string) as service_provider_uuid,
 '10.' || cast(user_id % 4 as string) || '.0.' || cast(event_id % 250 as string) as lan_ip,
 case when event_id % 50 = 0 then '2a02:26f0:0008:0183:0000:0000:0000:' || lpad(cast(event_id % 10000 as string),4,'0')
  else '86.121.' || cast(event_id % 64 as string) || '.' || cast(user_id % 250 as string) end as wan_ip,
 event_type as application_id_name from events
""",
    "fx_nmsp": """
select event_id, unix_timestamp(ts) as `timestamp`, case when event_type in ('signup','purchase') then 'info' else 'measure' end as type,
 '00:1c:b3:00:' || lpad(cast(user_id % 100 as string),2,'0') || ':' || lpad(cast(user_id % 7 as string),2,'0') as client_mac,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid,
 array('ap-'||cast(event_id%5 as string),'ap-'||cast(event_id%5+1 as string)) as ap_mac,
 array(cast(-40-event_id%60 as int), cast(-40-(event_id*7)%60 as int)) as rssi,
 'ap-'||cast(user_id%6 as string) as wireless_station, 'ssid-'||cast(user_id%2 as string) as wireless_id,
 cast(event_id % 4094 as int) as vlan_id from events
""",
    "fx_location10": """
select event_id, unix_timestamp(ts)*1000 as timestamp_ms, case when event_type = 'signup' then 'association' else 'locationupdate' end as notification_type,
 'd-' || cast(user_id as string) as device_id, 'ap-' || cast(event_id % 9 as string) as ap_mac_address,
 'C' || cast(event_id % 3 as string) || '>B' || cast(event_id % 5 as string) || case when event_id % 4 = 0 then '' else '>F' || cast(event_id % 7 as string) end as location_map_hierarchy,
 cast(case when event_id % 11 = 9 then 256 when event_id % 11 = 10 then 99 else event_id % 11 end as int) as status,
 case when event_id % 2 = 0 then '' else 'u' || cast(user_id as string) end as username,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid from events
""",
    "fx_radius": """
select c_custkey as id, 1441277328 + c_custkey as `timestamp`,
 'E0-B5-2D-16-' || lpad(cast(c_custkey % 100 as string),2,'0') || '-' || lpad(cast(c_custkey % 90 as string),2,'0') as calling_station_id,
 'F0-29-29-92-47-' || lpad(cast(c_custkey % 60 as string),2,'0') || case when c_custkey % 7 = 0 then '' else ':' || c_mktsegment end as called_station_id,
 case when c_custkey % 4 = 0 then null when c_custkey % 4 = 1 then 'Start' when c_custkey % 4 = 2 then 'Interim-Update' else 'Stop' end as acct_status_type,
 c_name as user_name, case when c_custkey % 3 = 0 then null else 'ns-' || cast(c_custkey % 4 as string) end as namespace_uuid from customer
""",
    "fx_sensors": """
select 1 as id, 'sp-0' as uuid, 'root' as name, 6 as domain_type, 0 as lft, 1000000 as rgt
union all select 10+r_regionkey, 'org-'||cast(r_regionkey as string), r_name, 2, r_regionkey*1000+1, r_regionkey*1000+999 from region
union all select 100+n_nationkey, 'mkt-'||cast(n_nationkey as string), n_name, 3, n_regionkey*1000+n_nationkey*30+2, n_regionkey*1000+n_nationkey*30+30 from nation
union all select cast(1000+s_suppkey as int), 'dep-'||cast(s_suppkey as string), s_name, 7, cast(n_regionkey*1000+n_nationkey*30+3+s_suppkey%26 as int), cast(n_regionkey*1000+n_nationkey*30+3+s_suppkey%26 as int) from supplier join nation on s_nationkey=n_nationkey
""",
    "fx_aps": """
select p_partkey as id, '00:aa:bb:' || lpad(cast(p_partkey % 100 as string),2,'0') || ':' || lpad(cast(p_partkey % 50 as string),2,'0') || ':00' as mac_address,
 cast(1001 + p_partkey % (select count(*) from supplier) as bigint) as sensor_id, p_retailprice/100 as latitude, -p_retailprice/50 as longitude from part
""",
    "fx_geo": """
select 4 as family, cast(1450770432 + n_nationkey*512 as bigint) as start_ip, cast(1450770432 + n_nationkey*512 + 511 - (n_nationkey%5)*40 as bigint) as end_ip,
 'C' || cast(n_nationkey as string) as country_code, 'AS' || cast(n_nationkey as string) || case when n_nationkey % 6 = 0 then '' else ' ' || n_name || ' Net' end as as_info from nation
union all select 4, cast(167772160 as bigint), cast(167903231 as bigint), 'P0', 'AS1 Wide Range'
""",
    "fx_threat": """
select ip, max(score) as darklist_score, 'cat-' || cast(max(score) % 3 as string) as darklist_category from (
 select lan_ip as ip, event_id % 100 as score from fx_flow where event_id % 60 = 0
 union all select wan_ip, event_id % 90 from fx_flow where event_id % 60 = 0) t group by ip
""",
    "fx_measure": """
select event_id, unix_timestamp(ts) as `timestamp`, event_type as type, event_type as monitor, value, 's-' || cast(user_id % 9 as string) as sensor_uuid,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid,
 'm-' || cast(user_id as string) as client_mac, 'ap-' || cast(event_id % 12 as string) as wireless_station, cast(event_id % 14 as int) as wireless_channel,
 cast(event_id % 30 as bigint) as wireless_tx_power, cast(-40 - event_id % 60 as bigint) as client_rssi_num, cast(event_id % 1600 as bigint) as dwell_time,
 's' || cast(event_id div 25 as string) as session, value / 10 as popularity, cast(event_id % 4 as bigint) as repetitions,
 'h' || cast(event_id % 33 as string) as hash, 'msg ' || cast(event_id % 21 as string) as msg, 'ep-' || cast(user_id % 17 as string) as endpoint_uuid,
 'ioc-' || cast(event_id % 13 as string) as ioc, cast(event_id % 500 as bigint) as followers, value as duration, -value as signal_strength from events
""",
    "fx_location89": """
select event_id, unix_timestamp(ts) as epoch, 'd-' || cast(user_id as string) as mac, 'ssid-' || cast(user_id % 3 as string) as ssid,
 'ap-' || cast(event_id % 9 as string) as ap, case event_id % 3 when 0 then 'ASSOCIATED' when 1 then 'PROBING' else null end as status,
 case when event_id % 5 = 0 then null else '10.0.' || cast(user_id % 250 as string) || '.' || cast(event_id % 250 as string) end as ip,
 'C' || cast(event_id % 3 as string) || case when event_id % 6 = 0 then '' else '>B' || cast(event_id % 5 as string) || '>F' || cast(event_id % 7 as string) || '>Z1' end as hierarchy,
 case when event_id % 10 = 0 then null else value / 7 end as lat, -value / 9 as lon,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid,
 case when event_id % 4 = 0 then null else 'sub-' || cast(event_id % 8 as string) end as subscription,
 case when event_id % 7 = 0 then 'inner-m' else null end as market_in, case when event_id % 14 = 0 then 'outer-m' else null end as market_out from events
""",
    "fx_meraki": """
select event_id, unix_timestamp(ts) as `timestamp`, case when event_id % 19 = 0 then null else 'd-' || cast(user_id as string) end as client_mac,
 case when user_id % 5 = 0 then null else 'ns-' || cast(user_id % 4 as string) end as namespace_uuid,
 cast(case when event_id % 10 = 0 then null else -(event_id % 95) end as int) as client_rssi_num,
 case when event_id % 3 = 0 then '10.0.0.' || cast(event_id % 250 as string) else null end as src,
 'ap-' || cast(event_id % 12 as string) as wireless_station, event_type as client_os from events
""",
    "fx_pms": """
select c_custkey as event_id, 'e0:b5:' || cast(c_custkey as string) as client_mac, case when c_custkey % 3 = 0 then null else 'ns-' || cast(c_custkey % 4 as string) end as namespace_uuid,
 case when c_custkey % 4 = 0 then null else c_name end as guest_name, case when c_custkey % 6 = 0 then c_mktsegment else null end as staff_name,
 case when c_custkey % 5 = 0 then 'female' when c_custkey % 8 = 0 then null when c_custkey % 4 = 0 then null else 'male' end as client_gender,
 case when c_custkey % 7 = 0 then 'sms' else null end as auth_type from customer
""",
}

# Spark spelling, DuckDB spelling
SPELLINGS = [
    ("unix_timestamp(ts)", "cast(floor(epoch(ts)) as bigint)"), ("as string", "as varchar"), ("array(", "list_value("),
    ("`", '"'), (" div ", " // "),
]


def duck(text: str) -> str:
    for spark_text, duck_text in SPELLINGS:
        text = text.replace(spark_text, duck_text)
    return text


def needed(text: str) -> list[str]:
    """Views that ``text`` uses, dependencies first."""
    found: list[str] = []
    for name in re.findall(r"\bfx_\w+", text):
        for n in [*needed(VIEWS[name]), name]:
            if n not in found:
                found.append(n)
    return found


def oracle(body: str, ctes: str = "") -> str:
    """DuckDB query over the views it mentions; ``ctes`` are further ``name as (...)`` parts."""
    parts = [f"{n} as ({duck(VIEWS[n]).strip()})" for n in needed(ctes + body)]
    if ctes:
        parts.append(ctes.strip().rstrip(","))
    return (f"with recursive {', '.join(parts)} " if parts else "") + body


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view (or, without the ``fx_`` prefix, a table) at ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    load = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if not name.startswith("fx_"):
        return load(name)
    chain = [*needed(VIEWS[name]), name]
    text = " ".join(VIEWS[n] for n in chain)
    for table in TABLES:
        if re.search(rf"\b(from|join) {table}\b", text):
            load(table).createOrReplaceTempView(table)
    for n in chain:
        frame = spark.sql(VIEWS[n])
        frame.createOrReplaceTempView(n)
    return frame
