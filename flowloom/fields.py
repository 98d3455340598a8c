"""Field groups, topic names and topic schemas."""

from __future__ import annotations

# Site dimensions copied from a record to its location output.
SITE_DIMS = [
    "market", "market_uuid", "organization", "organization_uuid", "deployment", "deployment_uuid",
    "sensor_name", "sensor_uuid", "namespace", "service_provider", "service_provider_uuid",
]

# Input topics.
FLOW, EVENT, NMSP, LOC, STATE, RADIUS, METRICS = (
    "rb_flow", "rb_event", "rb_nmsp", "rb_loc", "rb_state", "rb_radius", "rb_metrics",
)

# Enriched output topic of every input topic.
OUTPUT_TOPIC = {
    FLOW: "rb_flow_post",
    EVENT: "rb_event_post",
    NMSP: "rb_location",
    LOC: "rb_location",
    STATE: "rb_state_post",
    RADIUS: "rb_location",
    METRICS: "rb_monitor",
}

# Indexed topic, index target, base datasource.
ROUTES = [
    ("rb_flow_post", "flow", "rb_flow"),
    ("rb_event_post", "event", "rb_event"),
    ("rb_state", "state", "rb_state"),
    ("rb_state_post", "state", "rb_state"),
    ("rb_social", "social", "rb_social"),
    ("rb_hashtag", "hashtag", "rb_hashtag"),
    ("rb_malware_post", "malware", "rb_malware"),
    ("rb_monitor", "monitor", "rb_monitor"),
    ("rb_loc_post", "location", "rb_location"),
    ("rb_ioc_post", "ioc", "rb_ioc"),
    ("rb_changes", "changes", "rb_changes"),
    ("rb_iot_post", "iot", "rb_iot"),
    ("appmobile_signal_post", "appmobile_signal", "appmobile_signal"),
    ("appmobile_call_post", "appmobile_call", "appmobile_call"),
    ("rb_vault_post", "vault", "rb_vault"),
]

_SITE = ", ".join(f"{c} string" for c in SITE_DIMS)

#: DDL schema of each input topic. Byte counts stay text so that a malformed one can be told apart.
SCHEMAS = {
    FLOW: f"""timestamp bigint, first_switched bigint, bytes string, pkts string, client_mac string,
        wireless_station string, namespace_uuid string, lan_ip string, wan_ip string, src string, dst string,
        client_rssi_num bigint, application_id_name string, conversation string, direction string,
        engine_id_name string, host string, referer string, l4_proto string, sensor_ip string,
        lan_l4_port string, wan_l4_port string, lan_vlan string, wan_vlan string, tos string, type string,
        scatterplot string, {_SITE}""",
    EVENT: f"""timestamp bigint, client_mac string, namespace_uuid string, src string, dst string,
        src_port string, dst_port string, lan_ip string, wan_ip string, msg string, action string,
        classification string, priority string, sig_id string, sig_generator string, rev string,
        l4_proto string, ethsrc string, ethdst string, {_SITE}""",
    NMSP: f"""type string, timestamp bigint, client_mac string, namespace_uuid string, ap_mac array<string>,
        rssi array<int>, wireless_station string, wireless_channel string, wireless_id string,
        dot11_protocol string, dot11_status string, vlan_id int, {_SITE}""",
    LOC: f"""namespace_uuid string, {_SITE},
        StreamingNotification struct<timestamp: string, subscriptionName: string, deviceId: string,
            location: string, {_SITE.replace(' string', ': string')}>,
        notifications array<string>""",
    STATE: f"""timestamp bigint, type string, wireless_station string, wireless_channel string,
        wireless_tx_power bigint, wireless_admin_state string, wireless_op_state string, wireless_mode string,
        wireless_slot string, wireless_station_ip string, wireless_station_name string, status string,
        value double, namespace_uuid string, {_SITE}""",
    RADIUS: f"""timestamp bigint, `Packet-Src-IP-Address` string, `User-Name` string, `Operator-Name` string,
        `Airespace-Wlan_Id` string, `Calling-Station-Id` string, `Called-Station-Id` string,
        `Acct-Status-Type` string, namespace_uuid string, enrichment map<string,string>, {_SITE}""",
    METRICS: """asMap struct<header: struct<time: bigint, source: string, `container-name`: string>,
        metrics: map<string,map<string,double>>>""",
}
