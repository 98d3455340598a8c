"""Versioned tables, pinned snapshots, bucketed client state, merged minutes, topic outputs."""

import pytest
from pyspark.sql import functions as F

from flowloom import fields
from flowloom.operators import asof, nmsp, rollup
from flowloom.plans.index import index_sink, read_index
from flowloom.plans.topics import run_topic
from flowloom.sources.versioned import PinnedDimension, VersionedTable
from flowloom.streaming import topics, windows
from flowloom.streaming.asof import stream_asof
from flowloom.streaming.tables import asof_sink
from flowloom.streaming.wiring import run_available
from workload.views import view


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_versions_change_only_their_parts(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "p")
    assert table.versions() == [] and table.read(None) is None
    make = lambda *rows: spark.createDataFrame(list(rows), "p string, v int")
    table.commit(0, make(("a", 1), ("b", 2)), ["a", "b"])
    table.commit(3, make(("b", 3), ("c", 4)), ["b", "c"], base=0)
    assert rows_of(table.read(3).select("p", "v")) == [("a", 1), ("b", 3), ("c", 4)]
    assert rows_of(table.read(0).select("p", "v")) == [("a", 1), ("b", 2)]
    assert rows_of(table.read(3, ["b", "z"]).select("v")) == [(3,)] and table.read(3, ["z"]) is None
    table.commit(3, make(("b", 9)), ["b", "c"], base=0)  # again, as after a failure
    assert rows_of(table.read(3).select("p", "v")) == [("a", 1), ("b", 9)]
    table.commit(4, make(), ["a"], base=3)
    assert table.parts(4) == {"b": 3} and table.versions() == [0, 3, 4]
    assert table.vacuum(keep=1) == 2  # a and b of version 0; version 3 still holds b
    assert table.versions() == [4] and rows_of(table.read(4).select("p", "v")) == [("b", 9)]


def test_a_batch_keeps_its_snapshot(spark, tmp_path):
    now = [0]
    load = lambda: spark.createDataFrame([(now[0],)], "v int")
    dim = PinnedDimension(spark, str(tmp_path), load, every=2, keep=2)
    seen = []
    for batch in range(6):
        now[0] = batch
        seen.append(dim.at(batch).first()[0])
        now[0] = 100
        assert dim.at(batch).first()[0] == seen[-1]
        assert PinnedDimension(spark, str(tmp_path), load, every=2, keep=2).at(batch).first()[0] == seen[-1]
    assert seen == [0, 0, 2, 2, 4, 4] and len(dim.table.versions()) <= 3


def feed(spark, folder, df, parts):
    """Runs one after the other, each with the rows of one part."""
    for part in parts:
        df.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(df.schema).parquet(f"{folder}/in")


def test_state_in_buckets_expires_and_reruns(spark, tmp_path):
    schema = "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, v string"
    rows = [(i, 100 * i, f"c{i % 5}", None, f"v{i}") for i in range(10)] + [(20, 20_000, "late", None, "x"), (21, 40_000, "later", "n", "y"), (22, 40_001, None, None, "z")]
    df = spark.createDataFrame(rows, schema)

    def split(batch):
        state = batch.select("event_id", "timestamp", *nmsp.KEYS, *asof.state_columns(batch, {"last": ["v"]}).values())
        return batch.drop("v"), [state]
    folder = str(tmp_path / "s")
    sink = asof_sink(folder, split, ttl_seconds=3600, buckets=4, sweep=2)
    cuts = ["timestamp < 500", "timestamp >= 500 and timestamp < 1000", "timestamp = 20000", "timestamp >= 40000"]
    for i, stream in enumerate(feed(spark, folder, df, cuts)):
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
        table = VersionedTable(spark, f"{folder}/state/last", "bucket")
        kept = {r["client_mac"] for r in table.read(table.versions()[-1]).collect()}
        assert len(table.versions()) <= 2
        if i == 1:
            assert kept == {f"c{k}" for k in range(5)}
    assert "later" in kept and not {f"c{k}" for k in range(5)} & kept  # every bucket had its turn since
    out = {r["event_id"]: r["last"] for r in spark.read.parquet(f"{folder}/out").collect()}
    assert all(out[i]["v"] == f"v{i}" for i in range(10)) and out[22] is None
    before = rows_of(spark.read.parquet(f"{folder}/out/batch_id=3"))
    sink(df.filter("timestamp >= 40000"), 3)
    assert rows_of(spark.read.parquet(f"{folder}/out/batch_id=3")) == before


def test_keyed_state_goes_after_its_time(spark, tmp_path):
    schema = "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, v string"
    df = spark.createDataFrame([(i, i, f"c{i}", None, "a") for i in range(30)] + [(40, 5000, "new", None, "b"), (41, 5001, "c3", None, None), (42, 9000, "new", None, "c")], schema)
    folder, removed, last = str(tmp_path / "k"), 0, []
    for stream in feed(spark, folder, df, ["timestamp < 100", "timestamp = 5000 or timestamp = 5001", "timestamp > 6000"]):
        found = stream_asof(stream.filter("v is null").drop("v"), {"s": stream.filter("v is not null")}, nmsp.KEYS, ttl_seconds=3600)
        query = found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")
        query.awaitTermination()
        states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        removed += sum(s["numRowsRemoved"] for s in states)
        last.append(states[-1]["numRowsTotal"])
    assert removed >= 30 and last[-1] < last[0]  # clients silent for an hour are gone from the store
    assert [r["s"]["v"] for r in spark.read.parquet(f"{folder}/out").collect()] == ["a"]  # and c3 was there when its record came


def test_rows_of_a_client_leave_in_chunks(spark, tmp_path):
    """More records than one Arrow chunk holds wait in the store, out of order, and none is lost."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7")
    try:
        rows = [(i, (i * 37) % 100, "c", None, "s" if i % 10 == 0 else None) for i in range(100)]
        df = spark.createDataFrame(rows, "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, v string")
        stream = next(feed(spark, str(tmp_path / "f"), df, ["true"]))
        state = lambda d: d.filter("v is not null").select("event_id", "timestamp", *nmsp.KEYS, F.col("event_id").cast("string").alias("of"))
        probes = lambda d: d.filter("v is null").drop("v")
        live = run_available(stream_asof(probes(stream), {"s": state(stream)}, nmsp.KEYS), str(tmp_path / "o"))
        assert rows_of(live) == rows_of(asof.asof_lookup(probes(df), {"s": state(df)}, nmsp.KEYS))
    finally:
        spark.conf.set(setting, before)


def test_max_age_hides_old_states(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, "c", None, "s"), (2, 50, "c", None, None), (3, 110, "c", None, None)], "event_id bigint, timestamp bigint, client_mac string, namespace_uuid string, v string")
    stream = next(feed(spark, str(tmp_path / "f"), df, ["true"]))
    live = run_available(stream_asof(stream.filter("v is null").drop("v"), {"s": stream.filter("v is not null")}, nmsp.KEYS, max_age=60), str(tmp_path / "o"))
    assert {r["event_id"]: r["s"] and r["s"]["v"] for r in live.collect()} == {2: "s", 3: None}


def test_topic_outputs_of_micro_batches_and_reruns(spark, tmp_path):
    rows = [(i, t, t, "10", "1", ns) for i, (t, ns) in enumerate([(5, None), (61, None), (62, "n"), (130, None), (131, None), (200, "n"), (10, None), (250, None)])]
    df = spark.createDataFrame(rows, "event_id bigint, timestamp bigint, arrival bigint, bytes string, pkts string, namespace_uuid string")
    folder = str(tmp_path / "t")
    for stream in feed(spark, folder, df, ["event_id < 3", "event_id between 3 and 5", "event_id > 5"]):
        topics.run_stream(stream, folder, fields.FLOW)
    out = topics.read_outputs(spark, folder, closing=True)
    flows = {r["event_id"]: r["flows_count"] for r in out[0].collect()}
    assert flows == {0: None, 1: 1, 2: None, 3: 1, 4: 1, 5: 0, 6: None, 7: 0}
    counted = sorted((r["timestamp"], r["sensor_name"], r["value"]) for r in out.monitor.collect())
    base = "task-0-0-rb_flow"
    assert counted == [(60, base, 1), (60, base, 1), (120, base, 1), (120, f"{base}_n", 1), (180, base, 2), (240, f"{base}_n", 1), (300, base, 1)]
    assert len(topics.read_outputs(spark, folder).monitor.collect()) == len(counted) - 1  # the last window is open
    before = rows_of(out.monitor)
    topics.topic_sink(folder, fields.FLOW)(df.filter("event_id > 5"), 2)
    again = topics.read_outputs(spark, folder, closing=True)
    assert rows_of(again.monitor) == before and again[0].count() == 8


def test_weak_readings_are_counted_but_not_sent(spark, sf_dir):
    df = view(spark, sf_dir, "fx_nmsp")
    out = run_topic(df, fields.NMSP, window_seconds=60)
    judged = nmsp.judge_measures(nmsp.pair_with_info(df, nmsp.info_state(nmsp.nmsp_info(df))))
    sent, counted = out[0].count(), out.counts.agg(F.sum("events")).first()[0]
    assert counted == judged.count() + nmsp.nmsp_info(df).count() and sent < counted
    assert "_publish" not in out[0].columns and run_topic(df, fields.NMSP)[0].count() == sent
    assert run_topic(df, fields.EVENT, window_seconds=60).monitor is None


def test_minutes_merge_across_batches(spark, sf_dir, tmp_path):
    df = view(spark, sf_dir, "fx_measure").filter("event_id < 300").drop("event_id")
    sink = index_sink(str(tmp_path), "location", lambda b: {"rb_loc_post": b}, part_seconds=86_400)
    sink(df.filter("timestamp % 2 = 0"), 0)
    sink(df.filter("timestamp % 2 = 1"), 1)
    sink(df.filter("timestamp % 2 = 1"), 1)  # again
    found = read_index(spark, str(tmp_path), "location")
    dims = ["timestamp", "type", "sensor_uuid", "namespace_uuid"]
    exact = rollup.rollup(df, rollup.LOCATION, "exact")
    pick = lambda d: d.select(*[d[c] for c in dims], "events", "sum_dwell_time", "clients", "sessions")
    assert found.groupBy(*dims).count().filter("count > 1").count() == exact.groupBy(*dims).count().filter("count > 1").count()
    assert rows_of(pick(found)) == rows_of(pick(exact))  # sketches are exact for so few values
    assert read_index(spark, str(tmp_path), "flow") is None


def test_dwell_sketch_of_nothing(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 50)], "timestamp bigint, type string, dwell_time bigint")
    rows = rollup.rollup(df, rollup.LOCATION, mode="sketch")
    got = {r["type"]: r for r in rows.select("type", rollup.quantiles("hist_dwell_sketch", [0.5]).alias("q"), rollup.buckets("hist_dwell_sketch").alias("b")).collect()}
    assert got["a"]["q"] is None and got["a"]["b"] is None
    assert got["b"]["q"] == [50.0] and sum(x["count"] for x in got["b"]["b"]) == pytest.approx(1)


def test_windows_of_an_ended_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "a", "e") for i, t in enumerate([0, 10, 100, 5000, 5001, 5900])], "event_id bigint, timestamp bigint, ioc string, endpoint_uuid string")
    stream = next(feed(spark, str(tmp_path / "f"), df, ["true"]))
    found = windows.rollup_to_end(stream, df, rollup.IOC)
    assert {r["timestamp"]: r["events"] for r in found.collect()} == {0: 2, 60: 1, 4980: 2, 5880: 1}
    named = lambda d: d.withColumn("datasource", F.lit("d"))
    counts = windows.window_counts_to_end(named(stream), named(df))
    assert {r["window_start"]: r["events"] for r in counts.collect()} == {0: 2, 60: 1, 4980: 2, 5880: 1}


def test_first_rows_of_an_index_table_are_not_merged_anew(spark, tmp_path, monkeypatch):
    from flowloom.plans import index as plan

    calls = []
    merge = plan.merge_rollups
    monkeypatch.setattr(plan, "merge_rollups", lambda *a, **k: calls.append(1) or merge(*a, **k))
    write = plan.index_sink(str(tmp_path), "location", lambda batch: {"rb_loc_post": batch})
    rows = [(60, "a", "m1", 5), (61, "a", "m2", 7), (61, None, "m1", None)]
    df = spark.createDataFrame(rows, "timestamp bigint, sensor_uuid string, client_mac string, dwell_time bigint")
    seen = lambda: {r.sensor_uuid: (r.events, r.sum_dwell_time, r.clients, sum(r.hist_dwell)) for r in plan.read_index(spark, str(tmp_path), "location").collect()}
    write(df, 0)
    assert not calls
    assert seen() == {"a": (2, 12, 2, 2), None: (1, 0, 1, 0)}
    write(df.filter("client_mac = 'm1'"), 1)
    assert len(calls) == 1
    assert seen() == {"a": (3, 17, 2, 3), None: (2, 0, 1, 0)}
