"""Metrics, rollups, counters, capacity, routing, topics and the topic registry."""

import json
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators import counters, metrics, records, rollup
from flowloom.operators.lookup import StoreSpec
from flowloom.plans import topics
from flowloom.plans.route import route, split_routes
from flowloom.plans.index import index, index_schema, write_index
from flowloom.sources.topics import keyed_output, parse_json, read_topic, write_topic
from workload import windows as _  # noqa: F401  (registers rollup_flow)
from workload.catalog import QUERIES


def test_every_rollup_has_its_dimensions_and_limit():
    assert len(rollup.SPECS) == 14
    assert len(rollup.FLOW.dims) == len(set(rollup.FLOW.dims)) == 78
    assert {n: s.late for n, s in rollup.SPECS.items() if s.late != "10 minutes"} == {
        "flow": "15 minutes", "state": "20 minutes", "location": "30 minutes", "vault": "20 minutes"}


def test_rollup_events_add_up_and_absent_columns_are_left_out(spark):
    df = spark.range(500).select((F.col("id") % 300).alias("timestamp"), (F.col("id") % 3).cast("string").alias("src"), F.lit("m").alias("msg"))
    out = rollup.rollup(df, rollup.EVENT)
    assert out.columns == ["timestamp", "src", "msg", "events", "signatures"]
    assert out.agg(F.sum("events")).first()[0] == 500
    assert {r.timestamp for r in out.collect()} == {0, 60, 120, 180, 240}


def test_missing_time(spark):
    df = spark.createDataFrame([("x", None), ("x", "120")], "msg string, timestamp string")
    assert rollup.rollup(df, rollup.EVENT, now=F.lit(65).cast("bigint")).orderBy("timestamp").first().timestamp == 60
    assert rollup.rollup(df, rollup.CHANGES).agg(F.sum("events")).first()[0] == 1


def test_empty_sums_are_zero(spark):
    df = spark.createDataFrame([(0, "m", None)], "timestamp bigint, monitor string, value double")
    row = rollup.rollup(df, rollup.MONITOR).first()
    assert (row.sum_value, row.max_value, row.monitor) == (0.0, None, "m")


def test_schemaless_rollup_groups_by_the_open_part(spark):
    df = spark.createDataFrame(
        [(0, "m", "cpu", 1.0, {"b": "1", "a": "2"}), (1, "m", "mem", 2.0, {"a": "2", "b": "1"}), (2, "m", "cpu", 4.0, {"a": "3"})],
        "timestamp bigint, monitor string, type string, value double, extras map<string,string>")
    out = rollup.rollup(df, rollup.MONITOR)
    assert sorted(r.sum_value for r in out.collect()) == [3.0, 4.0] and "type" not in out.columns


def test_sketches_merge(spark):
    df = spark.range(3000).select((F.col("id") * 2).alias("timestamp"), F.lit("a").alias("ioc"), (F.col("id") % 700).cast("string").alias("endpoint_uuid"))
    from dataclasses import replace
    spec = replace(rollup.IOC, dims=("ioc",))
    hourly = rollup.merge_rollups(rollup.rollup(df, spec, mode="sketch"), spec, ["ioc"], "2 hours").collect()
    assert sum(r.events for r in hourly) == 3000
    assert hourly[0].endpoints == pytest.approx(700, rel=0.05) and hourly[0].iocs == 1


def test_dwell_histogram_bounds(spark):
    df = spark.range(2000).select(F.lit(0).cast("bigint").alias("timestamp"), F.col("id").alias("dwell_time"))
    row = rollup.rollup(df, rollup.LOCATION).first()
    assert (row.hist_dwell_below, row.hist_dwell_above) == (3, 559)
    assert sum(row.hist_dwell) == 2000 - 3 - 559 and len(row.hist_dwell) == 50
    # bins of two minutes add up
    two = df.union(df.withColumn("timestamp", F.lit(60).cast("bigint")))
    from dataclasses import replace
    spec = replace(rollup.LOCATION, dims=())
    merged = rollup.merge_rollups(rollup.rollup(two, spec, mode="sketch"), spec, []).first()
    assert merged.hist_dwell == [2 * n for n in row.hist_dwell] and merged.hist_dwell_above == 2 * 559


def test_window_rows(spark):
    df = spark.createDataFrame([("rb_flow_ns-1", 5), ("rb_flow_ns-1", 59), ("rb_loc_post", 61), (None, 5)], "datasource string, timestamp bigint")
    out = {r.sensor_name: (r.timestamp, r.value, r.namespace_uuid) for r in counters.window_counts(df).collect()}
    assert out == {"task-0-0-rb_flow_ns-1": (60, 2, "ns-1"), "task-0-0-rb_loc_post": (120, 1, None)}


def test_previous_window(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 61), ("a", 200), ("b", 61)], "datasource string, timestamp bigint")
    out = {(r.datasource, r.timestamp): r.flows_count for r in counters.with_prev_window_count(df).collect()}
    assert out == {("a", 1): None, ("a", 2): None, ("a", 61): 2, ("a", 200): 0, ("b", 61): None}


@pytest.mark.parametrize("loads, limit, expected", [
    ([0], 5, 1), ([100], 5, 5), ([3], 5, 3), ([3, 100], 4, 4), ([100, 0], 5, 1), ([4, 2], 5, 4), ([5, 3, 1], 5, 1), ([100, 4], 0, 1), ([100, 4], 5, 4), ([100, 3], 5, 5)])
def test_capacity(spark, loads, limit, expected):
    """Loads in tasks' worth of events: 60 s x 10 events per task / 2 topic partitions."""
    rows = [("rb_flow_x", i * 60, n * 10 * 60 // 2) for i, n in enumerate(loads)] + [("other", 0, 9)]
    df = spark.createDataFrame(rows, "datasource string, window_start bigint, events bigint")
    limits = spark.createDataFrame([("rb_flow_x", limit, 3)], "datasource string, index_partitions int, index_replicas int")
    row, = counters.capacity_report(df, limits, per_task=10, partitions={"rb_flow": 2}).collect()
    assert (row.datasource, row.partitions, row.replicas, row.windows) == ("rb_flow_x", expected, 3, len(loads))


def test_capacity_over_days(spark):
    """Days folded apart give what one pass over all windows gives."""
    import random
    rng = random.Random(3)
    loads = [rng.choice([0, 1, 3, 4, 7, 40]) for _ in range(400)]
    rows = [("rb_flow_x", i * 3600, n * 10 * 3600 // 2) for i, n in enumerate(loads)]
    df = spark.createDataFrame(rows, "datasource string, window_start bigint, events bigint")
    limits = spark.createDataFrame([("rb_flow_x", 6, 1)], "datasource string, index_partitions int, index_replicas int")
    current = 0
    for n in loads:
        load = n * 10 // 2 * 2
        wanted = max(-(-load // 10), 1)
        if current == 0 or current * 10 * 0.8 <= load:
            current = min(wanted, 6)
        elif current * 10 * 0.2 >= load:
            current = min(wanted, current)
    row, = counters.capacity_report(df, limits, seconds=3600, per_task=10, partitions={"rb_flow": 2}).collect()
    assert (row.partitions, row.windows) == (current, 400)


def test_index_job(spark, tmp_path):
    raw = [{"timestamp": "65", "src": "a", "sha256": "s1", "namespace_uuid": "n"}, {"timestamp": 70, "src": "a", "sha256": "s1", "namespace_uuid": "n"}, {"timestamp": 130, "src": "b"}]
    events, bad = parse_json(spark.createDataFrame([(json.dumps(r),) for r in raw], "value string"), "timestamp bigint, src string, namespace_uuid string", extras=True)
    out = index({"rb_event_post": events}, mode="exact")["event"]
    assert set(rollup.EVENT.dims) <= set(out.columns) and bad.count() == 0
    got = {(r.datasource, r.timestamp, r.src, r.sha256): r.events for r in out.collect()}
    assert got == {("rb_event_n", 60, "a", "s1"): 2, ("rb_event", 120, "b", None): 1}
    write_index({"event": out}, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i" / "event")).filter("datasource = 'rb_event_n'").first().events == 2
    with pytest.raises(KeyError):
        index({"no_such_topic": events})


def test_index_schemas_read_messages_of_every_target(spark):
    for topic, target, _ in fields.ROUTES:
        good, _ = parse_json(spark.createDataFrame([('{"timestamp": 5, "value": "x"}',)], "value string"), index_schema(target), extras=True)
        assert index({topic: good})[target].first().events == 1


def test_routes(spark):
    df = spark.createDataFrame([("rb_flow_post", "n"), ("rb_state", None), ("rb_loc_post", "n"), ("what", "n")], "topic string, namespace_uuid string")
    good, bad = split_routes(route(df))
    assert {(r.target, r.datasource) for r in good.collect()} == {("flow", "rb_flow_n"), ("state", "rb_state"), ("location", "rb_location_n")}
    assert [r.topic for r in bad.collect()] == ["what"]
    assert route(df, use_namespace=False).first().datasource == "rb_flow"


def test_rejects(spark):
    texts = ['{"a": 1}', "{}", " {\"a\": 2}", "[1]", "[{\"a\": 1}]", '"s"', "5", "null", '{"a": 1', "", None]
    good, bad = parse_json(spark.createDataFrame([(t,) for t in texts], "value string"), "a bigint")
    assert sorted(r.a for r in good.collect() if r.a) == [1, 2] and good.count() == 3
    assert bad.count() == len(texts) - 3


def test_ingest_is_tolerant(spark):
    texts = ['{"timestamp": "100", "n": "7.0", "d": "x", "list": ["1", 2, null], "other": {"k": [1]}, "none": null}', '{"timestamp": 5, "n": true, "list": "no list"}']
    good, bad = parse_json(spark.createDataFrame([(t,) for t in texts], "value string"), "timestamp bigint, n int, d double, list array<int>, m map<string,int>", extras=True)
    one, two = sorted(good.collect(), key=lambda r: -r.timestamp)
    assert bad.count() == 0 and (one.timestamp, one.n, one.d, one.list, one.m) == (100, 7, None, [1, 2, None], None)
    assert one.extras == {"other": '{"k":[1]}'} and (two.timestamp, two.n, two.list, two.extras) == (5, None, None, {})


def test_metrics_keep_other_values_beside_text(spark):
    snapshot = {"asMap": {"header": {"time": "5000", "source": "P 1", "container-name": "c"}, "metrics": {"org.example.A": {"n": 2, "state": "up"}}}}
    good, bad = parse_json(spark.createDataFrame([(json.dumps(snapshot),)], "value string"), fields.SCHEMAS[fields.METRICS])
    assert bad.count() == 0 and [r.value for r in metrics.flatten_job_metrics(good, "org.example").collect() if r.value is not None] == [2.0]


def test_write_and_read_a_topic(spark, tmp_path):
    df = spark.createDataFrame([("m", 1)], "client_mac string, bytes bigint")
    write_topic(keyed_output(df, F.col("client_mac")), str(tmp_path / "t"))
    row = read_topic(spark, str(tmp_path / "t"), "parquet").first()
    assert row.key == "m" and json.loads(row.value) == {"client_mac": "m", "bytes": 1}


def test_job_metrics(spark):
    snapshot = {"asMap": {"header": {"time": 1424767310026, "source": "TaskName-Partition 3", "container-name": "c"},
                          "metrics": {"org.Example.Steps.Flow": {"n": 2}, "java.Other": {"x": 1}}}}
    good, _ = parse_json(spark.createDataFrame([(json.dumps(snapshot),)], "value string"), fields.SCHEMAS[fields.METRICS])
    row, = metrics.flatten_job_metrics(good, "org.example").collect()
    assert row.asDict() == {"timestamp": 1424767310, "sensor_name": "c-3", "type": "flow", "monitor": "flow_n", "value": 2.0}


def test_registry(spark):
    flows = spark.createDataFrame([(100, 40, "10", "1", "m", 100)], "timestamp bigint, first_switched bigint, bytes string, pkts string, client_mac string, arrival bigint")
    table = spark.createDataFrame([("m", None, "b1")], "client_mac string, namespace_uuid string, building string")
    out, = topics.run_topic(flows, fields.FLOW, topics.Context(stores=[StoreSpec("s", table)]))
    rows = out.orderBy("timestamp").collect()
    assert [(r.timestamp, r.bytes, r.building, r.duration) for r in rows] == [(40, 3, "b1", 60), (60, 7, "b1", None)]
    with pytest.raises(KeyError):
        topics.run_topic(flows, "unknown")
    with pytest.raises(KeyError):
        topics.run_topic(flows, fields.FLOW, topics.Context(enrichers={"mac_vendor": lambda d: d}))


def test_registry_takes_new_steps(spark):
    topics.register("rb_guest", topics.guest_step)
    try:
        df = spark.createDataFrame([("m", "g")], "client_mac string, guest_name string")
        assert topics.run_topic(df, "rb_guest")[0].first().client_fullname == "g"
    finally:
        del topics.REGISTRY["rb_guest"]


def test_nmsp_topic_keeps_own_fields_over_the_store(spark):
    rows = [({"type": "info", "client_mac": "m", "wireless_station": "own", "wireless_id": "w", "timestamp": 5}),]
    good, _ = parse_json(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"), fields.SCHEMAS[fields.NMSP])
    good = good.withColumn("event_id", F.lit(1).cast("bigint"))
    table = spark.createDataFrame([("m", None, "store", "b")], "client_mac string, namespace_uuid string, wireless_station string, building string")
    out, = topics.run_topic(good, fields.NMSP, topics.Context(stores=[StoreSpec("s", table)]))
    row = out.first()
    assert (row.wireless_station, row.building, row.type) == ("own", "b", "nmsp-info")


def test_exact_counts_of_own_dimensions_expand_no_rows(spark):
    """A group holds one value of a dimension, so counting it needs no copy of the rows per counted column."""
    rows = [(60, "a", "m1", "s1"), (61, "a", "m1", "s1"), (62, "a", None, "s1"), (63, "a", None, None), (125, "a", "m2", None)]
    df = spark.createDataFrame(rows, "timestamp bigint, application_id_name string, client_mac string, wireless_station string").withColumns({"bytes": F.lit(2), "pkts": F.lit(1), "client_rssi_num": F.lit(-1)})
    out = rollup.rollup(df, rollup.FLOW, "exact")
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.timestamp, r.client_mac, r.wireless_station): (r.events, r.clients, r.wireless_stations) for r in out.collect()}
    assert got == {(60, "m1", "s1"): (2, 1, 1), (60, None, "s1"): (1, 0, 1), (60, None, None): (1, 0, 0), (120, "m2", None): (1, 1, 0)}


def test_a_message_is_parsed_once_whatever_is_asked_of_its_fields(spark, tmp_path):
    """Conditions on parsed fields are judged on what was parsed, not by parsing the text once more for each."""
    spark.createDataFrame([('{"a": "1", "kind": "x", "b": [1]}',), ('{"kind": "y"}',), ("[]",), (None,)], "value string").write.parquet(f"{tmp_path}/m")
    good, _ = parse_json(spark.read.parquet(f"{tmp_path}/m"), "a bigint, kind string, b array<int>", extras=True)
    asked = good.filter("kind = 'x' and a > 0 and size(b) > 0")
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(MapType") == 1
    assert [tuple(r) for r in asked.select("a", "kind", "b").collect()] == [(1, "x", [1])]


def test_kept_counts_join_wide_records_where_they_are(spark):
    """Of a kept table of the windows' counts the size is known, so the records are not shuffled to it; the result is the same."""
    rows = spark.range(3000).selectExpr("id", "concat('rb_flow_', id % 3) as datasource", "id % 7 * 60 + id % 60 as timestamp")
    counts = counters.datasource_counts(rows)
    table = counters.prev_window_table(counts).persist()
    assert table.count() == counts.count()
    found = counters.join_prev_window(rows, table)
    plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, counters.with_prev_window_count(rows, counts).collect()))
    table.unpersist()


def test_exact_counts_of_several_columns_expand_no_rows(spark):
    """A set per group and task goes through the one shuffle; the rows are not copied for each counted column."""
    rows = [(60, "m1", "s1"), (61, "m1", "s2"), (62, None, "s1"), (63, "", "s1"), (125, None, None)]
    df = spark.createDataFrame(rows, "timestamp bigint, client_mac string, wireless_station string").withColumns({"bytes": F.lit(2), "pkts": F.lit(1), "client_rssi_num": F.lit(-1)})
    spec = replace(rollup.FLOW, dims=())
    out = rollup.rollup(df, spec, "exact")
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert {r.timestamp: (r.events, r.clients, r.wireless_stations) for r in out.collect()} == {60: (4, 2, 2), 120: (1, 0, 0)}
    assert dict(out.dtypes)["clients"] == "bigint"


def test_estimated_counts_hold_no_registers_for_small_groups(spark):
    rows = [(60 * i, f"m{i}", "s") for i in range(50)] + [(0, "", None), (0, None, "t"), (6000, None, None)]
    df = spark.createDataFrame(rows, "timestamp bigint, client_mac string, wireless_station string").withColumns({"bytes": F.lit(2), "pkts": F.lit(1), "client_rssi_num": F.lit(-1)})
    out = rollup.rollup(df, replace(rollup.FLOW, dims=()))
    assert "approx_count_distinct" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.timestamp: (r.events, r.clients, r.wireless_stations) for r in out.collect()}
    assert got == {60 * i: (1, 1, 1) for i in range(1, 50)} | {0: (3, 2, 2), 6000: (1, 0, 0)}
    assert dict(out.dtypes)["clients"] == "bigint"


def test_wide_dimensions_are_shuffled_once_per_flow(spark, tmp_path):
    """The query's slices are not shuffled: flows are, before the split, and no aggregate is keyed by the dimensions."""
    events = [(i, f"2024-01-01 00:{i % 50:02d}:30", i % 7, "view", float(i), "{}") for i in range(60)] + [(None, None, None, None, 2.0, None)]
    spark.createDataFrame(events, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string").selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    out = QUERIES["rollup_flow"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")
    assert not any("Aggregate(" in line and "http_user_agent" in line for line in plan.splitlines())
    rows = out.collect()
    assert sum(r.sum_bytes for r in rows) == sum(range(60)) * 1000 and {r.host for r in rows} <= {f"host-{k}" for k in range(4)}


ODD_FLOWS = [
    # texts that run together, NULL and empty text, equal flows, other minutes
    ("a", "bc", 1, 0.0, "m", "s"), ("ab", "c", 1, 0.0, "m", "s"), ("a", "bc", 1, -0.0, "m", "s"), (None, "bc", 1, 0.0, None, ""), ("", "bc", 1, 0.0, "", None),
    ("bc", None, 1, 0.0, "m", None), (None, None, None, None, None, None), (None, None, None, None, None, None), ("1, 2]", "[null", 12, 1.5, "m", "s"), ("null", ",", 1, 2.0, "-", "-"),
    ("é", "\x00", 1, 2.0, "m", "s"), ("é", "", 1, 2.0, "m", "s"),
]


@pytest.mark.parametrize("complete", [False, True])
def test_dimensions_apart_give_the_same_rollup(spark, complete):
    rows = [(i % 3 * 100, i % 3 * 100 + 90 * (i % 2), 1000 * i, i, -i, *r) for i, r in enumerate(ODD_FLOWS * 3)] + [(None, None, None, None, None, *ODD_FLOWS[0])]
    df = spark.createDataFrame(rows, """first_switched bigint, timestamp bigint, bytes bigint, pkts bigint, client_rssi_num bigint,
        host string, referer string, lan_l4_port bigint, tos double, client_mac string, wireless_station string""").withColumn("now", F.lit(400).cast("bigint"))
    apart = rollup.Apart(rollup.FLOW)
    got = rollup.rollup(records.flow(df, before_split=apart.take), rollup.FLOW, "exact", complete=complete, apart=apart)
    want = rollup.rollup(records.flow(df), rollup.FLOW, "exact", complete=complete)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > len(ODD_FLOWS)
    assert "lan_l4_port" in apart.dims and not {"tos", "duration"} & {*apart.dims}
    with pytest.raises(ValueError):
        rollup.rollup(records.flow(df, before_split=apart.take), rollup.FLOW, apart=apart)


def test_dimensions_apart_without_any_and_with_metrics_among_them(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 7, "a"), (61, 7, None)], "timestamp bigint, duration bigint, number string")
    none = rollup.Apart(rollup.FLOW)
    assert rollup.rollup(none.take(df.drop("number")), rollup.FLOW, "exact", apart=none).count() == 3
    spec = replace(rollup.APPMOBILE_CALL, dims=("number", "followers"), aggs={**rollup.APPMOBILE_CALL.aggs, "n": ("distinct", "number"), "f": ("lsum", "followers"), "h": ("histogram", "duration")})
    df = df.withColumn("followers", F.lit(3))
    apart = rollup.Apart(spec)
    got, want = rollup.rollup(apart.take(df), spec, "exact", apart=apart), rollup.rollup(df, spec, "exact")
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        rollup.Apart(rollup.MONITOR)


def test_dimensions_that_change_between_readings_are_an_error(spark):
    other = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
    df = spark.range(3).select(F.lit(1).cast("bigint").alias("timestamp"), other().alias("host"))
    apart = rollup.Apart(rollup.FLOW)
    with pytest.raises(Exception, match="other dimensions than when they were read first"):
        rollup.rollup(apart.take(df), rollup.FLOW, "exact", apart=apart).collect()
