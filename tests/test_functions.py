"""Scalar expressions."""

import pytest
from pyspark.sql import functions as F

from flowloom.functions import address, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("ip, expected", [
    ("2a02:26f0:8:183::90", "62a0226f0000801830000000000000090"),
    ("::1", "6" + "0" * 31 + "1"),
    ("::", "6" + "0" * 32),
    ("fe80::", "6fe80" + "0" * 28),
    ("::ffff:1.2.3.4", "6" + "0" * 20 + "ffff01020304"),
    ("86.121.44.1", "456792c01"),
    ("010.1.2.003", "40a010203"),
    ("256.1.1.1", None),
    ("1:2:3", None),
    ("1::2::3", None),
    ("nonsense", None),
    ("1:2:3:4:5:6:7:8:9", None),
    ("12345::", None),
    (None, None),
])
def test_ip_key(spark, ip, expected):
    assert one(spark, address.ip_key(F.lit(ip).cast("string"))) == expected


@pytest.mark.parametrize("ip, family", [("1.2.3.4", 4), ("::1", 6), ("text", 6), ("1.2.3", 6)])
def test_ip_family(spark, ip, family):
    assert one(spark, address.ip_family(F.lit(ip))) == family


@pytest.mark.parametrize("called, station, ssid", [
    ("F0:29:29:92:47:C0:SPG-HS20", "f0:29:29:92:47:c0", "SPG-HS20"),
    ("F0-29-29-92-47-C0-net", "f0:29:29:92:47:c0", "net"),
    ("F0:29:29:92:47:C0:", "f0:29:29:92:47:c0", ""),
    ("F0:29:29:92:47:C0", None, None),
    ("other", None, None),
])
def test_station(spark, called, station, ssid):
    assert tuple(one(spark, address.station_parse(F.lit(called)))) == (station, ssid)


@pytest.mark.parametrize("mac, oui", [("00:1c:b3:09:85:15", "001CB3"), (" 00-1c-b3-00-00-00", "001CB3"), ("00:1c", None)])
def test_oui(spark, mac, oui):
    assert one(spark, address.oui(F.lit(mac))) == oui


@pytest.mark.parametrize("rssi, label, profile", [
    (0, "unknown", "hard"), (-90, "bad", "soft"), (-85, "bad", "soft"), (-80, "low", "soft"), (-75, "medium", "soft"),
    (-70, "medium", "medium"), (-65, "good", "medium"), (-60, "good", "hard"), (-40, "excellent", "hard"), (5, "excellent", "hard"),
])
def test_labels(spark, rssi, label, profile):
    assert one(spark, text.rssi_label(F.lit(rssi))) == label
    assert one(spark, text.client_profile(F.lit(rssi))) == profile


def test_labels_of_nothing(spark):
    assert one(spark, text.rssi_label(F.lit(None).cast("int"))) is None


def test_strongest(spark):
    pick = lambda aps, rssis: tuple(one(spark, text.strongest_ap(F.array(*map(F.lit, aps)), F.array(*map(F.lit, rssis)))))
    assert pick(["a", "b", "c"], [-80, -54, -32]) == ("c", -32)
    assert pick(["a", "b"], [-50, -50]) == ("a", -50)


@pytest.mark.parametrize("path, expected", [
    ("A>B>C>D", ("A", "B", "C", "D")), ("A>B", ("A", "B", None, None)), ("A", ("A", None, None, None)), ("A>B>", ("A", "B", None, None)),
])
def test_zone(spark, path, expected):
    assert tuple(one(spark, text.zone_path(F.lit(path)))) == expected


@pytest.mark.parametrize("x, expected", [(-0.000025, -0.00002), (0.000025, 0.00003), (37.3912345, 37.39123)])
def test_round5(spark, x, expected):
    assert one(spark, text.round5(F.lit(x))) == pytest.approx(expected, abs=1e-12)


def test_latlng_text(spark):
    assert one(spark, text.latlng(F.lit(37.3912345), F.lit(-5.98))) == "37.39123,-5.98"
    assert one(spark, text.latlng(F.lit(None).cast("double"), F.lit(1.0))) is None


@pytest.mark.parametrize("stamp, expected", [
    ("2015-03-31T02:57:38.570-0700", 1427795858), ("2015-03-31T02:57:38.570-07:00", 1427795858),
    ("2015-03-31T09:57:38Z", 1427795858), ("yesterday", None),
])
def test_iso(spark, stamp, expected):
    assert one(spark, text.iso_seconds(F.lit(stamp))) == expected


@pytest.mark.parametrize("info, name", [("AS123 Some Name", "Some Name"), ("AS123", "AS123"), (None, None)])
def test_as_name(spark, info, name):
    assert one(spark, text.as_name(F.lit(info).cast("string"))) == name


@pytest.mark.parametrize("value, expected", [("12", 12), ("2.0E9", None), ("2000000000.0", None), ("x", None)])
def test_as_long(spark, value, expected):
    assert one(spark, text.as_long(F.lit(value))) == expected


@pytest.mark.parametrize("code, name", [(3, "ASSOCIATED"), (257, "WAIT_ASSOCIATED"), (99, None)])
def test_status(spark, code, name):
    assert one(spark, text.status_name(F.lit(code))) == name
