"""Associations, locations, accounting and as-of state; hot keys take the chunked path in every case."""

import json
import random

import pytest
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators import asof, location, nmsp, records
from flowloom.sources.topics import parse_json

NMSP = fields.SCHEMAS[fields.NMSP] + ", event_id bigint"


def nmsp_rows(spark, *rows):
    text = [(json.dumps({"client_mac": "m", "event_id": i, "timestamp": 1000 + i, **r}),) for i, r in enumerate(rows)]
    good, bad = parse_json(spark.createDataFrame(text, "value string"), NMSP)
    assert bad.count() == 0
    return good


def measures(spark, *rows):
    df = nmsp_rows(spark, *rows)
    out = nmsp.nmsp_measure(df, nmsp.info_state(nmsp.nmsp_info(df)))
    return [r.asDict() for r in out.orderBy("event_id").collect()]


MEASURE = {"type": "measure", "ap_mac": ["11", "22", "33"], "rssi": [-80, -54, -32]}
INFO = {"type": "info", "wireless_station": "22", "wireless_id": "rb_Corp", "vlan_id": 40, "dot11_protocol": "a"}


def test_strongest_station_without_association(spark):
    row, = measures(spark, {**MEASURE, "sensor_name": "s", "namespace_uuid": "n"})
    assert (row["wireless_station"], row["client_rssi_num"], row["client_rssi"]) == ("33", -32, "excellent")
    assert (row["dot11_status"], row["type"], row["sensor_name"], row["namespace_uuid"]) == ("PROBING", "nmsp-measure", "s", "n")


def test_heard_association(spark):
    row, = measures(spark, INFO, MEASURE)
    assert (row["wireless_station"], row["client_rssi_num"], row["client_rssi"]) == ("22", -54, "excellent")
    assert (row["dot11_status"], row["wireless_id"], row["lan_vlan"], row["dot11_protocol"]) == ("ASSOCIATED", "rb_Corp", 40, "a")


def test_unheard_association_drops_the_record(spark):
    assert measures(spark, {**INFO, "wireless_station": "99"}, MEASURE) == []


@pytest.mark.parametrize("age, status", [(3599, "ASSOCIATED"), (3600, "PROBING"), (4000, "PROBING")])
def test_association_expires(spark, age, status):
    row, = measures(spark, {**INFO, "timestamp": 5000}, {**MEASURE, "timestamp": 5000 + age})
    assert row["dot11_status"] == status


def test_namespaces_do_not_mix(spark):
    row, = measures(spark, {**INFO, "namespace_uuid": "a"}, {**MEASURE, "namespace_uuid": "b"})
    assert row["dot11_status"] == "PROBING"


@pytest.mark.parametrize("rssi, label", [(-80, "low"), (-70, "medium"), (-60, "good"), (-40, "excellent"), (0, "unknown")])
def test_published_labels(spark, rssi, label):
    row, = measures(spark, {"type": "measure", "ap_mac": ["1"], "rssi": [rssi]})
    assert row["client_rssi"] == label


def test_weak_reading_is_kept_back_but_leaves_state(spark):
    df = nmsp_rows(spark, {"type": "measure", "ap_mac": ["1"], "rssi": [-90]})
    judged = nmsp.judge_measures(nmsp.pair_with_info(df, nmsp.info_state(nmsp.nmsp_info(df))))
    assert judged.filter("_publish").count() == 0
    state = nmsp.client_history(nmsp.info_state(nmsp.nmsp_info(df)), judged)[0].first()["nmsp-measure"]
    assert (state.client_rssi, state.dot11_status) == ("bad", "ASSOCIATED")


def test_empty_readings_are_ignored(spark):
    assert measures(spark, {"type": "measure", "ap_mac": [], "rssi": []}, {"type": "measure"}, {"type": "other"}) == []


def test_info_output(spark):
    row = nmsp.nmsp_info(nmsp_rows(spark, {**INFO, "market": "mk"})).first().asDict()
    assert (row["type"], row["lan_vlan"], row["last_seen"], row["dot11_status"], row["client_profile"], row["market"]) == (
        "nmsp-info", 40, 1000, "ASSOCIATED", "hard", "mk")


def test_expired_association_is_gone_for_later_records(spark):
    """A measure that finds an expired association removes it, so a later flow no longer sees it."""
    df = nmsp_rows(spark, {**INFO, "timestamp": 0}, {**MEASURE, "timestamp": 5000})
    info = nmsp.info_state(nmsp.nmsp_info(df))
    judged = nmsp.judge_measures(nmsp.pair_with_info(df, info))
    flows = spark.createDataFrame([(1, "m", 4999), (2, "m", 5001), (3, None, 5001)], "event_id bigint, client_mac string, timestamp bigint")
    out = asof.asof_lookup(flows, {}, shared=nmsp.client_history(info, judged))
    seen = {r.event_id: (r["nmsp-info"] and r["nmsp-info"].wireless_id, r["nmsp-measure"] and r["nmsp-measure"].wireless_station) for r in out.collect()}
    assert seen == {1: ("rb_Corp", None), 2: (None, "33"), 3: (None, None)}


# ---------------------------------------------------------------- hot keys


def brute_last(rows):
    known, out = {}, {}
    for key, ts, seq, state in sorted(rows, key=lambda r: r[1:3]):
        if state is not None:
            known[key] = state
        out[key, ts, seq] = known.get(key)
    return out


@pytest.mark.parametrize("hot_rows, tie_block", [(10**9, 1 << 20), (0, 1 << 20), (0, 3), (40, 4)])
def test_running_last_against_brute_force(spark, hot_rows, tie_block):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "a", "b", "c", None]), rng.choice([100, 100, 101, 3599, 3600, 9000, 20000]), i,
             f"s{i}" if rng.random() < 0.2 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts bigint, seq bigint, s string").withColumn("st", F.when(F.col("s").isNotNull(), F.struct("s")))
    out = asof.running_last(df, ["k"], ["ts", "seq"], ["st"], hot_rows=hot_rows, tie_block=tie_block)
    assert {(r.k, r.ts, r.seq): r.st and r.st.s for r in out.collect()} == brute_last(rows)


def v10(spark, *rows):
    base = {"deviceId": "d"}
    text = [(i, [json.dumps({**base, "timestamp": (1424767310 + i) * 1000 + 26, **n}) for n in (r if isinstance(r, list) else [r])]) for i, r in enumerate(rows)]
    return spark.createDataFrame(text, "event_id bigint, notifications array<string>")


UPDATE = {"notificationType": "locationupdate", "locationMapHierarchy": "CampusA>BuildingB>FloorC>ZoneD", "apMacAddress": "ap1", "ssid": "net", "subscriptionName": "sub", "namespace_uuid": "n"}
ASSOC = {"notificationType": "association", "ssId": "SSID", "band": "b", "apMacAddress": "ap2", "status": 3, "username": "", "subscriptionName": "sub", "namespace_uuid": "n"}


def test_v10_update_before_any_association(spark):
    row = location.location_v10(v10(spark, UPDATE)).first().asDict()
    assert (row["campus"], row["building"], row["floor"], row["zone"]) == ("CampusA", "BuildingB", "FloorC", "ZoneD")
    assert (row["timestamp"], row["dot11_status"], row["type"], row["namespace_uuid"]) == (1424767310, "PROBING", "mse10-location", "n")
    assert (row["wireless_id"], row["sensor_name"], row["client_profile"]) == ("net", "sub", None)


def test_v10_association_then_update(spark):
    out = [r.asDict() for r in location.location_v10(v10(spark, ASSOC, UPDATE, {**UPDATE, "namespace_uuid": "other"})).orderBy("event_id").collect()]
    a, same, other = out
    assert (a["dot11_status"], a["wireless_id"], a["namespace_uuid"], a["client_profile"], a["client_id"]) == ("ASSOCIATED", "SSID", None, "hard", None)
    assert (same["dot11_status"], same["wireless_id"], same["wireless_station"], same["campus"]) == ("ASSOCIATED", "SSID", "ap2", "CampusA")
    assert (other["dot11_status"], other["wireless_id"], other["wireless_station"]) == ("PROBING", "net", "ap1")


def test_v10_list_is_handled_once_and_in_order(spark):
    out = location.location_v10(v10(spark, [ASSOC, UPDATE, {"notificationType": "other"}])).collect()
    assert sorted(r.type for r in out) == ["mse10-association", "mse10-location"]
    assert {r.dot11_status for r in out} == {"ASSOCIATED"}


FOLLOWED = ["wireless_station", "client_id", "campus", "building", "dot11_status", "wireless_id"]


def brute_follow(rows, sticky):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["timestamp"], r["event_id"])):
        key = (r["client_mac"], r["namespace_uuid"])
        cur = {f: r[f] for f in FOLLOWED}
        if not r["_reset"]:
            old = state.get(key)
            if old is None:
                cur["dot11_status"] = "PROBING"
            else:
                for f in FOLLOWED:
                    cur[f] = (old[f] if old[f] is not None else cur[f]) if sticky else (cur[f] if cur[f] is not None else old[f])
        state[key] = cur
        out[r["event_id"]] = tuple(cur[f] for f in FOLLOWED)
    return out


@pytest.mark.parametrize("sticky", [True, False])
@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_followed_rows_against_a_fold(spark, sticky, hot_rows):
    rng = random.Random(11)
    maybe = lambda *v: rng.choice([None, None, *v])
    rows = []
    for i in range(300):
        reset = rng.random() < 0.06
        rows.append({
            "event_id": i, "timestamp": rng.choice([10, 11, 3600, 3700, 8000, 90000]), "client_mac": rng.choice(["a", "a", "a", "b"]),
            "namespace_uuid": rng.choice([None, "n"]), "_pos": 0, "_reset": reset, "wireless_station": maybe("s1", "s2"),
            "client_id": maybe("c1") if reset else None, "campus": None if reset else maybe("x", "y"),
            "building": None if reset else maybe("p", "q"), "dot11_status": maybe("ASSOCIATED", "IDLE") if reset else None, "wireless_id": maybe("w")})
    schema = "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, _pos int, _reset boolean, " + ", ".join(f"{f} string" for f in FOLLOWED)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    out = location.follow_clients(df, sticky=sticky, hot_rows=hot_rows).collect()
    assert {r.event_id: tuple(r[f] for f in FOLLOWED) for r in out} == brute_follow(rows, sticky)


def test_cloud_controller_record_resets_clients_without_namespace(spark):
    cloud = spark.createDataFrame([(0, 5, "d", None, -50, "10.0.0.1", "apM")],
                                  "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, client_rssi_num int, src string, wireless_station string")
    rows = location.notifications(v10(spark, {**UPDATE, "namespace_uuid": None}, {**UPDATE, "namespace_uuid": "n"}))
    out = {r.namespace_uuid: r for r in location.follow_clients(rows, location.meraki_state(location.meraki(cloud))).collect()}
    assert (out[None].dot11_status, out[None].wireless_station) == ("ASSOCIATED", "apM")
    assert (out["n"].dot11_status, out["n"].wireless_station) == ("PROBING", "ap1")


# ---------------------------------------------------------------- other records


def v89_message(**over):
    loc = {"macAddress": "mac", "ssId": "net", "apMacAddress": "ap", "dot11Status": "ASSOCIATED", "ipAddress": ["10.0.0.1", "x"],
           "MapInfo": {"mapHierarchyString": "A>B>C"}, "GeoCoordinate": {"latitude": 1.000005, "longitude": -2.5}}
    loc.update(over.pop("location", {}))
    return {"StreamingNotification": {"timestamp": "2015-03-31T02:57:38.570-0700", "subscriptionName": "sub", "location": loc, **over}, "namespace_uuid": "n"}


def located(spark, message):
    good, _ = parse_json(spark.createDataFrame([(json.dumps(message),)], "value string"), fields.SCHEMAS[fields.LOC])
    return location.location(good.withColumn("event_id", F.lit(1).cast("bigint"))).first().asDict()


def test_v89_full_record(spark):
    row = located(spark, v89_message())
    want = {"timestamp": 1427795858, "campus": "A", "building": "B", "floor": "C", "dot11_status": "ASSOCIATED", "wireless_id": "net",
            "wireless_station": "ap", "lan_ip": "10.0.0.1", "client_rssi": "unknown", "client_snr": "unknown", "client_profile": "hard",
            "type": "mse", "sensor_name": "sub", "namespace_uuid": "n", "client_mac": "mac", "client_latlong": "1.00001,-2.5"}
    assert {k: row[k] for k in want} == want


def test_v9_spelling(spark):
    row = located(spark, v89_message(location={"MapInfo": None, "GeoCoordinate": None, "mapInfo": {"mapHierarchyString": "X>Y"}, "geoCoordinate": {"lattitude": 3.0, "longitude": 4.0}}))
    assert (row["campus"], row["building"], row["floor"], row["client_latlong"]) == ("X", "Y", None, "3.0,4.0")


def test_v89_probing_hides_association_fields(spark):
    row = located(spark, v89_message(location={"dot11Status": "PROBING", "MapInfo": None}))
    assert (row["wireless_id"], row["wireless_station"], row["lan_ip"], row["campus"]) == (None, None, None, None)


def test_v89_outer_dimensions_win(spark):
    message = {**v89_message(market="inner", sensor_name="s-in"), "market": "outer"}
    row = located(spark, message)
    assert (row["market"], row["sensor_name"]) == ("outer", "s-in")


RADIUS = {"timestamp": 1441277328, "Packet-Src-IP-Address": "128.136.224.78", "User-Name": "user", "Operator-Name": "op", "Airespace-Wlan-Id": "19",
          "Acct-Status-Type": "Start", "Calling-Station-Id": "E0-B5-2D-16-E9-10", "Called-Station-Id": "F0:29:29:92:47:C0:SPG-HS20", "enrichment": {"sensor_uuid": 23131}}


def accounted(spark, **over):
    message = {k: v for k, v in {**RADIUS, **over}.items() if v is not None}
    good, _ = parse_json(spark.createDataFrame([(json.dumps(message),)], "value string"), fields.SCHEMAS[fields.RADIUS])
    return records.radius(good.withColumn("event_id", F.lit(1).cast("bigint")), now=F.lit(77).cast("bigint"))


def test_radius_record(spark):
    row = records.radius_output(accounted(spark)).first().asDict()
    want = {"client_mac": "e0:b5:2d:16:e9:10", "wireless_station": "f0:29:29:92:47:c0", "wireless_id": "SPG-HS20", "client_id": "user",
            "wireless_operator": "op", "sensor_ip": "128.136.224.78", "client_accounting_type": "start", "sensor_uuid": "23131",
            "timestamp": 1441277328, "type": "radius", "client_profile": "hard"}
    assert {k: row[k] for k in want} == want


def test_radius_time_and_missing_client(spark):
    assert accounted(spark, timestamp=None).first().timestamp == 77
    assert accounted(spark, **{"Calling-Station-Id": None}).count() == 0


@pytest.mark.parametrize("status, kept", [("Start", 1), ("Interim-Update", 1), (None, 1), ("Stop", 0)])
def test_radius_state(spark, status, kept):
    state = records.radius_state(accounted(spark, **{"Acct-Status-Type": status}))
    assert state.count() == kept


def test_guest_profiles(spark):
    df = spark.createDataFrame([("m", "guest", "staff", None), ("m", "guest", None, "vip"), ("m", None, None, None)],
                               "client_mac string, guest_name string, staff_name string, client_vip string")
    assert sorted(r.client_fullname for r in records.guest_profiles(df).collect()) == ["guest", "staff"]
