"""Store chains, guards, enrichers, vendors, threats, ranges, pseudonyms."""

import pytest
from pyspark.sql import functions as F

from flowloom.operators import hierarchy, lookup, privacy, ranges
from flowloom.operators.lookup import StoreSpec
from flowloom.sources import dimensions

FLOW = "client_mac string, wireless_station string, namespace_uuid string, building string"


def chain(spark, row, *stores):
    return lookup.lookup_chain(spark.createDataFrame([row], FLOW), stores).first().asDict()


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_every_store_contributes_and_later_keys_see_earlier_columns(spark):
    clients = table(spark, [("m1", "n1", "ap1")], "client_mac string, namespace_uuid string, wireless_station string")
    places = table(spark, [("ap1", "b1", "f1")], "wireless_station string, building string, floor string")
    out = chain(spark, ("m1", None, "n1", None), StoreSpec("c", clients), StoreSpec("p", places, ("wireless_station",), overwrite=False))
    assert (out["wireless_station"], out["building"], out["floor"]) == ("ap1", "b1", "f1")


def test_last_overwriting_store_wins(spark):
    stores = [StoreSpec(n, table(spark, [("m1", "n1", n)], "client_mac string, namespace_uuid string, building string")) for n in ("s1", "s2")]
    assert chain(spark, ("m1", None, "n1", "own"), *stores)["building"] == "s2"


def test_without_overwrite_the_record_wins(spark):
    s = StoreSpec("s", table(spark, [("m1", "n1", "store")], "client_mac string, namespace_uuid string, building string"), overwrite=False)
    assert chain(spark, ("m1", None, "n1", "own"), s)["building"] == "own"
    assert chain(spark, ("m1", None, "n1", None), s)["building"] == "store"


def test_namespaces_are_separate(spark):
    s = StoreSpec("s", table(spark, [("m1", "n1", "one"), ("m1", None, "none")], "client_mac string, namespace_uuid string, floor string"))
    assert chain(spark, ("m1", None, "n1", None), s)["floor"] == "one"
    assert chain(spark, ("m1", None, "n2", None), s)["floor"] is None
    assert chain(spark, ("m1", None, None, None), s)["floor"] == "none"


def test_keys_are_compared_column_by_column(spark):
    s = StoreSpec("s", table(spark, [("ab", "c", "hit"), (None, None, "nobody")], "client_mac string, namespace_uuid string, floor string"))
    assert chain(spark, ("a", None, "bc", None), s)["floor"] is None
    assert chain(spark, (None, None, None, None), s)["floor"] is None


def test_absent_key_column(spark):
    df = spark.createDataFrame([("x",)], "other string")
    s = StoreSpec("s", table(spark, [("m1", "n1", "one")], "client_mac string, namespace_uuid string, floor string"))
    assert lookup.lookup_chain(df, [s]).first().floor is None


@pytest.mark.parametrize("row_ns, table_ns, hit", [("n1", "n1", True), ("n1", "n2", False), (None, "n2", True), ("n1", None, True)])
def test_guard_compares_namespaces(spark, row_ns, table_ns, hit):
    t = table(spark, [("ap1", table_ns, "b1")], "wireless_station string, namespace_uuid string, floor string")
    out = chain(spark, ("m", "ap1", row_ns, None), StoreSpec("sensor", t, ("wireless_station",), guard_namespace=True))
    assert (out["floor"] == "b1") is hit


def test_guard_uses_the_namespace_the_record_came_with(spark):
    first = StoreSpec("c", table(spark, [("m1", "n9")], "client_mac string, namespace_uuid string"), ("client_mac",))
    t = table(spark, [("ap1", "n1", "b1")], "wireless_station string, namespace_uuid string, floor string")
    out = chain(spark, ("m1", "ap1", "n1", None), first, StoreSpec("sensor", t, ("wireless_station",), guard_namespace=True))
    assert out["floor"] == "b1"


def test_earlier_enrichers_fill_and_the_last_replaces(spark):
    put = lambda name, value: lambda df: df.withColumn(name, F.lit(value))
    df = spark.createDataFrame([("old", None)], "a string, b string")
    out = lookup.enrich_chain(df, [put("a", "x"), put("b", "y"), put("c", "z")]).first()
    assert (out.a, out.b, out.c) == ("old", "y", "z")
    assert lookup.enrich_chain(df, [put("a", "x")]).first().a == "x"
    assert lookup.enrich_chain(df, []).first().asDict() == {"a": "old", "b": None}


def test_scrambled_mac_is_seen_by_later_enrichers_but_not_earlier_ones(spark):
    vendors = table(spark, [("B418D1", "Maker")], "oui string, vendor string")
    salts = table(spark, [("sp", "6A285A12B390A55E021EB983B20D5F4E")], "uuid string, salt string")
    df = spark.createDataFrame([("b4:18:d1:6e:81:01", "sp")], "client_mac string, service_provider_uuid string")
    out = lookup.enrich_chain(df, [lookup.vendor_enricher(vendors), privacy.mac_enricher(salts)]).first()
    assert (out.client_mac, out.client_mac_vendor) == ("ec:19:1a:2d:07:e7", "Maker")


PSEUDONYMS = [("b418d16e8101", "ec:19:1a:2d:07:e7"), ("b418d16e8102", "cb:36:a8:1a:d9:2c"), ("b418d16e8104", "92:62:10:43:52:5b")]


def test_pseudonyms(spark):
    salts = table(spark, [("sp", "6A285A12B390A55E021EB983B20D5F4E"), ("bad", "zz")], "uuid string, salt string")
    rows = [(i, m, "sp") for i, (m, _) in enumerate(PSEUDONYMS)] + [
        (10, "b418d16e8101", "bad"), (11, "b418d16e8101", "none"), (12, None, "sp"), (13, "b4-18", "sp"), (14, "b418d16e8101", None)]
    df = spark.createDataFrame(rows, "i int, client_mac string, service_provider_uuid string")
    out = {r.i: r.client_mac for r in privacy.scramble_macs(df, salts).collect()}
    assert [out[i] for i in range(len(PSEUDONYMS))] == [p for _, p in PSEUDONYMS]
    assert [out[i] for i in (10, 11, 12, 13, 14)] == ["b418d16e8101", "b418d16e8101", None, "b4-18", "b418d16e8101"]
    other = privacy.scramble_macs(df, salts, prefix="another").filter("i = 0").first().client_mac
    assert other != PSEUDONYMS[0][1]


def test_vendor(spark, tmp_path):
    path = tmp_path / "vendors"
    path.write_text("001CB3|Apple\nAABBCC|First\nAABBCC|Second\nbroken\n")
    vendors = dimensions.vendor_table(spark, str(path))
    df = spark.createDataFrame([("00:1C:B3:09:85:15",), ("AA:AA:AA:AA:AA:AA",), ("aa-bb-cc-00-00-00",), ("00:1",), (None,)], "client_mac string")
    out = [r.client_mac_vendor for r in lookup.vendor_lookup(df, vendors).orderBy(F.col("client_mac")).collect()]
    assert sorted(v for v in out if v) == ["Apple", "Second"] and len(out) == 5


def test_missing_vendor_file(spark):
    vendors = dimensions.vendor_table(spark, "/no/such/file")
    df = spark.createDataFrame([("00:1C:B3:09:85:15",)], "client_mac string")
    assert lookup.vendor_lookup(df, vendors).first().client_mac_vendor is None


def test_threats(spark, tmp_path):
    path = tmp_path / "threats.json"
    path.write_text('[{"ip": "1.1.1.1", "enrich_with": {"darklist_score": 10, "darklist_category": "old"}},'
                    '{"ip": "1.1.1.1", "enrich_with": {"darklist_score": 80, "darklist_category": "a"}},'
                    '{"ip": "2.2.2.2", "enrich_with": {"darklist_score": 80, "darklist_category": "b"}},'
                    '{"ip": "3.3.3.3", "enrich_with": {"darklist_category": "c"}}]')
    threats = dimensions.threat_table(spark, str(path))
    ends = [("1.1.1.1", "2.2.2.2"), ("1.1.1.1", "3.3.3.3"), ("1.1.1.1", "9.9.9.9"), ("9.9.9.9", "2.2.2.2"), (None, "2.2.2.2"), ("9.9.9.9", None), (None, None)]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "i int, src string, dst string")
    out = [(r.darklist_direction, r.darklist_category) for r in lookup.threat_lookup(df, threats).orderBy("i").collect()]
    assert out == [("both", "b"), ("both", "a"), ("source", "a"), ("destination", "b"), ("destination", "b"), ("clean", "clean"), ("clean", "clean")]


@pytest.fixture(scope="module")
def geo(spark):
    country = spark.createDataFrame([
        ("86.120.0.0", "86.127.255.255", 4, "RO"), ("2a02:26f0::", "2a02:26f0:ffff:ffff:ffff:ffff:ffff:ffff", 6, "EU"),
        ("8.0.0.0", "8.255.255.255", 4, "US"), ("8.8.8.0", "8.8.8.255", 4, "GG")], "start_ip string, end_ip string, family int, country_code string")
    asn = spark.createDataFrame([
        ("86.120.0.0", "86.127.255.255", 4, "AS8708 RCS & RDS SA"), ("2a02:26f0::", "2a02:26f0:ffff:ffff:ffff:ffff:ffff:ffff", 6, "AS20940 Akamai Technologies European AS"),
        ("9.9.9.9", "9.9.9.9", 4, "AS19281")], "start_ip string, end_ip string, family int, as_info string")
    return country, asn


def located(spark, lan, wan, country, asn):
    df = spark.createDataFrame([(lan, wan)], "lan_ip string, wan_ip string")
    return ranges.geo_lookup(df, country, asn).first().asDict()


def test_geo_wan_over_lan(spark, geo):
    out = located(spark, "86.121.44.1", "2a02:26f0:8:183::90", *geo)
    assert out["lan_ip_country_code"] == "RO" and out["wan_ip_country_code"] == "EU" and out["ip_country_code"] == "EU"
    assert out["lan_ip_as_name"] == "RCS & RDS SA" and out["ip_as_name"] == "Akamai Technologies European AS"
    assert out["public_ip"] == "2a02:26f0:8:183::90"


def test_geo_lan_only(spark, geo):
    out = located(spark, "86.121.44.1", "192.168.1.1", *geo)
    assert (out["ip_country_code"], out["public_ip"], out["wan_ip_country_code"]) == ("RO", "86.121.44.1", None)


def test_geo_private_and_missing(spark, geo):
    assert located(spark, "10.0.0.1", None, *geo)["public_ip"] is None
    assert located(spark, "86.121.44.1", None, None, None) == {"lan_ip": "86.121.44.1", "wan_ip": None}
    only_as = located(spark, "9.9.9.9", "8.8.8.8", geo[0], geo[1])
    assert (only_as["ip_as_name"], only_as["ip_country_code"], only_as["public_ip"]) == ("AS19281", "GG", "8.8.8.8")


def test_missing_range_files(spark):
    assert dimensions.range_tables(spark, "/no/such/a", None) == (None, None)


def test_ranges_against_brute_force(spark):
    import random
    rng = random.Random(7)
    spans = []
    for _ in range(300):
        lo = rng.randrange(2**32)
        spans.append((lo, min(lo + rng.randrange(2 ** rng.randrange(1, 30)), 2**32 - 1)))
    spans += [(0, 2**32 - 1), (2**31 - 1, 2**31)]
    table = spark.createDataFrame([(a, b, 4, f"{a}-{b}") for a, b in spans], "start_ip bigint, end_ip bigint, family int, v string")
    points = sorted({p for a, b in spans for p in (a, b, (a + b) // 2)})
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    ips = spark.createDataFrame([(text(p),) for p in points], "ip string")
    got = {r.ip: r._value for r in ranges.address_values(ips, ranges.range_table(table, "v")).collect()}
    for p in points:
        inside = [(a, -b, f"{a}-{b}") for a, b in spans if a <= p <= b]
        assert got[text(p)] == max(inside)[2]


def test_narrowest_range_wins_and_family_is_kept(spark):
    table = spark.createDataFrame([
        ("10.0.0.0", "10.255.255.255", 4, "wide"), ("10.0.0.0", "10.0.0.255", 4, "narrow"), ("2a02::", "2a02:ffff:ffff:ffff:ffff:ffff:ffff:ffff", 6, "w6"),
        ("2a02::", "2a02::ffff", 6, "n6"), ("11.0.0.0", "11.0.0.9", 6, "contradiction")], "start_ip string, end_ip string, family int, v string")
    ips = spark.createDataFrame([("10.0.0.5",), ("10.9.0.5",), ("2a02::5",), ("2a02:1::5",), ("11.0.0.5",)], "ip string")
    got = {r.ip: r._value for r in ranges.address_values(ips, ranges.range_table(table, "v")).collect()}
    assert got == {"10.0.0.5": "narrow", "10.9.0.5": "wide", "2a02::5": "n6", "2a02:1::5": "w6"}
    numbers = spark.createDataFrame([(5, 9, 6, "x"), (5, 9, 4, "y")], "start_ip bigint, end_ip bigint, family int, v string")
    assert [r.hi is None for r in ranges.range_table(numbers, "v").orderBy("_value").collect()] == [True, False]


def test_doubled_dimension_rows_do_not_double_records(spark):
    vendors = spark.createDataFrame([("001CB3", "A"), ("001CB3", "B")], "oui string, vendor string")
    df = spark.createDataFrame([("00:1C:B3:09:85:15", "1.1.1.1", "2.2.2.2")], "client_mac string, src string, dst string")
    assert [r.client_mac_vendor for r in lookup.vendor_lookup(df, vendors).collect()] == ["B"]
    threats = spark.createDataFrame([("1.1.1.1", 5, "low"), ("1.1.1.1", 9, "high")], "ip string, darklist_score int, darklist_category string")
    assert [r.darklist_category for r in lookup.threat_lookup(df, threats).collect()] == ["high"]


def test_last_line_wins_over_several_files(spark, tmp_path):
    for name, vendor in (("a", "Old"), ("b", "New")):
        (tmp_path / name).write_text(f"001CB3|{vendor}\n")
    assert dimensions.vendor_table(spark, str(tmp_path)).first().vendor == "New"


def test_refresh_cadence(spark):
    loads = iter(range(100))
    dim = dimensions.Refreshing(lambda: next(loads))
    assert [dim.tick() for _ in range(12)] == [0, 0, 0, 0, 0, 1, 1, 1, 1, 1, 2, 2]


def test_ranges_of_version_6_over_many_blocks(spark):
    import ipaddress
    import random
    rng = random.Random(11)
    base, spans = int(ipaddress.ip_address("2a02::")), []
    for _ in range(120):
        lo = base + rng.randrange(2 ** rng.choice([40, 90, 110]))
        spans.append((lo, lo + rng.randrange(2 ** rng.randrange(1, 112))))
    text = lambda n: str(ipaddress.ip_address(n))
    table = spark.createDataFrame([(text(a), text(b), 6, f"{a}-{b}") for a, b in spans], "start_ip string, end_ip string, family int, v string")
    points = sorted({p for a, b in spans for p in (a - 1, a, b, b + 1, (a + b) // 2, a | (2**80 - 1), b & ~(2**80 - 1))})
    ips = spark.createDataFrame([(text(p),) for p in points] + [("no address",), ("",)], "ip string")
    got = {r.ip: r._value for r in ranges.address_values(ips, ranges.range_table(table, "v")).collect()}
    want = {text(p): max((a, -b, f"{a}-{b}") for a, b in spans if a <= p <= b)[2] for p in points if any(a <= p <= b for a, b in spans)}
    assert got == want and len(want) > 300


def test_geo_by_row_id_equals_geo_by_side(spark, geo):
    rows = [(1, "86.121.44.1", "8.8.8.8"), (2, None, "2a02:26f0:8:183::90"), (3, "9.9.9.9", None), (4, None, None), (5, "text", ""), (6, "8.8.8.8", "8.8.8.8")]
    df = spark.createDataFrame(rows, "event_id long, lan_ip string, wan_ip string")
    plain, slim = (sorted(map(str, ranges.geo_lookup(df, *geo, row_id=r).collect())) for r in (None, "event_id"))
    assert plain == slim and len(plain) == 6


def test_sensors_on_one_place_are_asked_for_once(spark, monkeypatch):
    """Many sensors with the same interval make one pair per place and level, not one per sensor and node."""
    rows = [(1, "root", "u1", 6, 0, 1000)] + [(100 + i, f"dep{i}", f"d{i}", 7, 5, 5) for i in range(300)] + [(900, "null", "n", 7, None, None)]
    sensors = spark.createDataFrame(rows, "id int, name string, uuid string, domain_type int, lft int, rgt int")
    made = []

    def counted(points, intervals, width, least=0):
        out = ranges.stab(points, intervals, width, least)
        made.append(out.count())
        return out
    monkeypatch.setattr(hierarchy, "stab", counted)
    got = {r["_sensor"]: (r["service_provider"], r["deployment"]) for r in hierarchy.ancestors(sensors).collect()}
    assert made[0] <= 4
    assert got == {1: ("root", None), **{100 + i: ("root", "dep0") for i in range(300)}}


def test_uses_of_addresses_are_not_broadcast(spark, tmp_path):
    """However small their file is said to be, records meet the addresses in as many tasks as there are partitions."""
    spark.range(50).selectExpr("id", "concat('10.0.0.', id % 5) as lan_ip", "concat('86.121.0.', id % 7) as wan_ip").write.parquet(f"{tmp_path}/f")
    df = spark.read.parquet(f"{tmp_path}/f")
    table = spark.createDataFrame([(4, "86.121.0.0", "86.121.0.3", "ES", "AS1 Net")], "family int, start_ip string, end_ip string, country_code string, as_info string")
    out = ranges.geo_lookup(df, table, table, addresses_of=df, row_id="id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    uses = [line for line in plan.split("\n") if "Join [ip#" in line and " Inner" in line]
    assert uses and all("SortMergeJoin" in line for line in uses)
    assert {r.id: r.ip_country_code for r in out.collect()} == {i: "ES" if i % 7 < 4 else None for i in range(50)}
