"""Streams cut into several micro-batches give what the batch operators give."""

import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from flowloom.operators import asof, counters, location, nmsp, records, rollup
from flowloom.sources.versioned import VersionedTable
from flowloom.streaming import clients, windows
from flowloom.streaming.asof import stream_asof
from flowloom.streaming.tables import asof_sink
from flowloom.streaming.wiring import PROVIDER_SETTING, run_available
from workload.clients import as_notification
from workload.scalar import FLOW_SMALL
from workload.views import view


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """A frame as a stream of ``n`` files, one per micro-batch, in event order."""
    def make(df, n=3):
        folder = tmp_path_factory.mktemp("feed")
        rows = df.count()
        for i in range(n):
            part = df.filter((F.col("event_id") >= rows * i // n) & (F.col("event_id") < rows * (i + 1) // n))
            part.coalesce(1).write.mode("append").parquet(str(folder / "in"))
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    return make


def same(a, b):
    cols = sorted(a.columns)
    rows = lambda d: sorted(map(str, d.select(*cols).collect()))
    assert sorted(b.columns) == cols
    assert rows(a) == rows(b)


def test_flow_slices(spark, sf_dir, feed):
    flows = view(spark, sf_dir, "fx_flow").filter("event_id < 300")
    same(run_available(records.flow(feed(flows), now="arrival")), records.flow(flows, now="arrival"))


def test_measures(spark, sf_dir, feed):
    df = view(spark, sf_dir, "fx_nmsp")
    batch = nmsp.judge_measures(nmsp.pair_with_info(df, nmsp.info_state(nmsp.nmsp_info(df))))
    same(run_available(clients.stream_nmsp(feed(df))), batch)


@pytest.mark.parametrize("sticky", [True, False])
def test_locations(spark, sf_dir, feed, sticky):
    df = view(spark, sf_dir, "fx_location10").select("event_id", F.array(as_notification()).alias("notifications"))
    same(run_available(clients.stream_location(feed(df), sticky=sticky)), location.location_v10(df, sticky=sticky))


def test_asof(spark, sf_dir, feed):
    flows = view(spark, sf_dir, "fx_flow").select("event_id", "timestamp", "client_mac", "namespace_uuid", "pkts")
    info = nmsp.info_state(nmsp.nmsp_info(view(spark, sf_dir, "fx_nmsp")))
    both = view(spark, sf_dir, "fx_nmsp")
    stream = feed(both)
    live = stream_asof(
        stream.filter("type = 'measure'").select("event_id", "timestamp", "client_mac", "namespace_uuid", "vlan_id"),
        {"i": nmsp.info_state(nmsp.nmsp_info(stream))})
    probes = both.filter("type = 'measure'").select("event_id", "timestamp", "client_mac", "namespace_uuid", "vlan_id")
    same(run_available(live), asof.asof_lookup(probes, {"i": info}))
    assert flows.count() == 1000


def test_late_records_are_left_out(spark, tmp_path):
    schema = "timestamp bigint, ioc string, endpoint_uuid string"
    for i, stamps in enumerate([[0, 10, 5000], [5001], [20, 4900, 9000]]):
        spark.createDataFrame([(s, "a", "e") for s in stamps], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = run_available(windows.stream_rollup(stream, rollup.IOC))
    # 20 arrives after the limit has passed its minute; 4900 is still accepted
    got = {r.timestamp: r.events for r in out.collect()}
    assert got == {0: 2, 4860: 1, 4980: 2}


def test_capacity_over_windows(spark, feed, tmp_path):
    loads = [3, 100, 3, 0]
    rows = [("rb_flow_x", i * 60, n * 10 * 60 // 2, i) for i, n in enumerate(loads)]
    df = spark.createDataFrame(rows, "datasource string, window_start bigint, events bigint, event_id bigint")
    limits = spark.createDataFrame([("rb_flow_x", 5, 3)], "datasource string, index_partitions int, index_replicas int")
    out = run_available(windows.stream_capacity(feed(df, 2).drop("event_id"), limits, per_task=10, partitions={"rb_flow": 2}))
    assert [(r.partitions, r.replicas) for r in out.orderBy("window_start").collect()] == [(3, 3), (5, 3), (5, 3), (1, 3)]


def test_records_without_a_client_pass(spark, sf_dir, feed):
    keyless = F.when(F.col("event_id") % 3 != 0, F.col("client_mac"))
    df = view(spark, sf_dir, "fx_nmsp").filter("event_id < 300").withColumn("client_mac", keyless)
    batch = nmsp.judge_measures(nmsp.pair_with_info(df, nmsp.info_state(nmsp.nmsp_info(df))))
    assert batch.filter("client_mac is null").count() > 0
    same(run_available(clients.stream_nmsp(feed(df, 2))), batch)
    notes = as_notification()
    where = view(spark, sf_dir, "fx_location10").filter("event_id < 300").withColumn("device_id", F.when(F.col("event_id") % 3 != 0, F.col("device_id")))
    rows = where.select("event_id", F.array(notes).alias("notifications"))
    wanted = location.location_v10(rows)
    assert wanted.filter("client_mac is null").count() == 100
    same(run_available(clients.stream_location(feed(rows, 2))), wanted)


def test_batch_sink_and_resume(spark, sf_dir, tmp_path, feed):
    flows = view(spark, sf_dir, "fx_flow").filter("event_id < 200")
    sink = windows.batch_sink(lambda b: counters.with_prev_window_count(b.withColumn("datasource", F.lit("d"))), str(tmp_path / "out"))
    q = feed(flows).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
    folder = str(tmp_path / "again")
    stream = feed(flows)
    first = run_available(stream, folder).count()
    assert run_available(stream, folder).count() == first == 200


def test_window_counts(spark, sf_dir, feed):
    flows = view(spark, sf_dir, "fx_flow").select("event_id", "timestamp", F.lit("d").alias("datasource"))
    out = run_available(windows.stream_window_counts(feed(flows).drop("event_id")))
    last = flows.agg(F.max("timestamp")).first()[0]
    same(out, counters.datasource_counts(flows).filter(F.col("window_start") + 60 <= last))


def test_flow_rollup_keeps_mergeable_sketches(spark, sf_dir, feed):
    flows = view(spark, sf_dir, "fx_flow")
    out = run_available(windows.stream_rollup(records.flow(feed(flows, 2), now="arrival"), FLOW_SMALL))
    merged = rollup.merge_rollups(out, FLOW_SMALL, ["application_id_name"])
    assert merged.agg(F.sum("events")).first()[0] == out.agg(F.sum("events")).first()[0]


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_asof_with_state_in_a_table(spark, sf_dir, feed, tmp_path, hot_rows):
    df = view(spark, sf_dir, "fx_nmsp").withColumn("rank", F.lit(1))

    def split(batch):
        info = nmsp.info_state(nmsp.nmsp_info(batch))
        state = info.select(*nmsp.KEYS, "timestamp", "event_id", *asof.state_columns(info, {"known": ["wireless_id", "last_seen"]}).values())
        return batch.filter("type = 'measure'").select("event_id", "timestamp", *nmsp.KEYS, "vlan_id"), [state]

    sink = asof_sink(str(tmp_path / "t"), split, hot_rows=hot_rows)
    q = feed(df, 2).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    probes, states = split(df)
    same(spark.read.parquet(str(tmp_path / "t" / "out")).drop("batch_id"), asof.asof_lookup(probes, {}, shared=states))


def test_previous_window_over_micro_batches(spark, feed, tmp_path):
    stamps = [1, 2, 61, 62, 63, 125, 130, 300, 301]
    df = spark.createDataFrame([(i, t, "b" if t == 62 else "a") for i, t in enumerate(stamps)], "event_id bigint, timestamp bigint, datasource string")
    sink = windows.prev_window_sink(str(tmp_path / "w"))
    feed(df, 3).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    # the windows are cut by the micro-batches, so a row of a later batch may see more of the window before it, never less
    got = {r.event_id: r.flows_count for r in spark.read.parquet(str(tmp_path / "w" / "out")).collect()}
    assert got == {r.event_id: r.flows_count for r in counters.with_prev_window_count(df).collect()}
    assert got[5] == 2 and got[7] == 0 and got[0] is None


@pytest.mark.parametrize("name", ["stream_nmsp_measure", "stream_client_asof"])
def test_keyed_state_in_a_session_with_the_default_store(spark, tmp_path, name):
    """Timers and lists need RocksDB; a session that names another store keeps it, and the queries still run."""
    kinds = ["signup", "view", "click"]
    rows = [(i, datetime.datetime(2024, 1, 1, i % 5, i % 60), i % 7, kinds[i % 3], 1.0, "{}") for i in range(60)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(PROVIDER_SETTING)
    spark.conf.set(PROVIDER_SETTING, default)
    try:
        got = queries()[name](spark, str(tmp_path))
        assert spark.conf.get(PROVIDER_SETTING) == default
        measures = events.filter("event_type <> 'signup'").count()
        wanted = queries()["nmsp_measure"](spark, str(tmp_path)).count() if name == "stream_nmsp_measure" else measures
        assert got.count() == wanted > 0
    finally:
        spark.conf.set(PROVIDER_SETTING, before)


def test_states_of_a_micro_batch_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        made.add(1)
        return x

    rows = [(i, i, "m" if i % 3 else "n", None if i % 2 else "x", f"v{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, v string")

    def split(batch):
        worked = batch.withColumn("v", counted("v"))
        place = [*nmsp.KEYS, "timestamp", "event_id"]
        one = worked.filter("event_id < 8").select(*place, *asof.state_columns(worked, {"a": ["v"]}).values())
        two = worked.filter("event_id >= 4").select(*place, *asof.state_columns(worked, {"a": ["v"], "b": ["v"]}).values())
        return batch.select(*place), [one, two]

    write = asof_sink(str(tmp_path / "t"), split)
    write(df, 0)
    assert made.value == 8 + 8
    write(df.filter("client_mac = 'n'").withColumns({c: F.col(c) + 20 for c in ("event_id", "timestamp")}), 1)
    kept = lambda n: {(r.client_mac, r.namespace_uuid, r.event_id, r[n].v) for r in VersionedTable(spark, str(tmp_path / "t" / "state" / n), "bucket").read(1).collect()}
    assert kept("a") == kept("b") == {("m", None, 11, "v11"), ("m", "x", 10, "v10"), ("n", None, 29, "v9"), ("n", "x", 26, "v6")}
