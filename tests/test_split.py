"""Slices of a flow: arithmetic, lateness, future times, malformed counts, duration."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from flowloom.functions.text import flow_duration
from flowloom.operators.split import split_flows

SCHEMA = "first_switched bigint, timestamp bigint, bytes string, pkts string, duration bigint, now bigint"


def at(clock, day="2014-01-01"):
    return int(datetime.fromisoformat(f"{day} {clock}").replace(tzinfo=timezone.utc).timestamp())


def clock(epoch):
    return datetime.fromtimestamp(epoch, timezone.utc).strftime("%H:%M:%S")


def slices(spark, start, end, now, nbytes="999", pkts="99", duration=None):
    row = (start and at(start), end and at(end), nbytes, pkts, duration, at(now))
    out = split_flows(spark.createDataFrame([row], SCHEMA)).orderBy("timestamp").collect()
    return [(clock(r.timestamp), r.bytes, r.pkts) for r in out]


VECTORS = {
    "within a minute": (("22:10:12", "22:10:42", "22:15:16"), [("22:10:12", 999, 99)]),
    "several minutes": (("22:10:12", "22:13:42", "22:15:16"), [
        ("22:10:12", 228, 22), ("22:11:00", 285, 28), ("22:12:00", 285, 28), ("22:13:00", 201, 21)]),
    "start corrected": (("21:58:12", "22:01:42", "22:22:16"), [("22:00:16", 511, 50), ("22:01:00", 488, 49)]),
    "too old, kept": (("21:50:12", "21:55:42", "22:22:16"), [
        ("21:50:12", 145, 14), ("21:51:00", 181, 18), ("21:52:00", 181, 18), ("21:53:00", 181, 18),
        ("21:54:00", 181, 18), ("21:55:00", 130, 13)]),
    "grace window": (("21:50:12", "21:50:42", "22:12:16"), [("21:50:12", 999, 99)]),
    "future": (("21:55:12", "22:01:42", "21:36:16"), [("21:36:16", 999, 99)]),
    "future, split": (("21:45:12", "22:01:42", "21:47:16"), [
        ("21:45:12", 386, 38), ("21:46:00", 483, 47), ("21:47:00", 130, 14)]),
}


@pytest.mark.parametrize("name", VECTORS)
def test_vectors(spark, name):
    times, expected = VECTORS[name]
    assert slices(spark, *times) == expected


def test_large_counts(spark):
    out = slices(spark, "10:01:26", "10:06:26", "10:15:16", "316402980", "316402980")
    assert [b for _, b, _ in out] == [35859004, 63280596, 63280596, 63280596, 63280596, 27421592]
    assert [p for _, _, p in out] == [b for _, b, _ in out]


def test_huge_count_does_not_overflow(spark):
    total = 9_000_000_000_000_000_000
    out = slices(spark, "10:01:00", "10:04:00", "10:15:16", str(total), "3")
    assert sum(b for _, b, _ in out) == total and len(out) == 3


@pytest.mark.parametrize("nbytes", ["2000000000.0", "many"])
def test_unreadable_bytes_drop_the_row(spark, nbytes):
    assert slices(spark, "22:10:12", "22:13:42", "22:15:16", nbytes) == []


def test_unreadable_pkts_drop_the_row(spark):
    assert slices(spark, "22:10:12", "22:13:42", "22:15:16", "10", "1.5") == []


def test_absent_counts_are_zero_when_times_are_given(spark):
    assert slices(spark, "22:10:12", "22:10:42", "22:15:16", None, None) == [("22:10:12", 0, 0)]


def test_without_first_switched(spark):
    assert slices(spark, None, "22:10:42", "22:15:16") == [("22:10:42", 999, 99)]
    assert slices(spark, None, "22:10:42", "22:15:16", None) == []


def test_without_timestamp_takes_arrival(spark):
    assert slices(spark, "22:10:12", None, "22:15:16") == [("22:15:16", 999, 99)]
    assert slices(spark, None, None, "22:15:16", "1e3") == []


def test_duration_stays_on_the_first_slice(spark):
    row = (at("22:10:12"), at("22:13:42"), "999", "99", 94, at("22:15:16"))
    out = split_flows(spark.createDataFrame([row], SCHEMA)).orderBy("timestamp").collect()
    assert [r.duration for r in out] == [94, None, None, None]
    assert all(r.first_switched is None for r in out)


def test_very_long_flow_is_whole(spark):
    """An old record may span years; no slice is lost and the total is kept."""
    row = (at("00:00:30", "2013-12-01"), at("00:00:10"), "1000000000", "7", None, at("22:00:00"))
    out = split_flows(spark.createDataFrame([row], SCHEMA))
    n, total, distinct = out.agg(F.count("*"), F.sum("bytes"), F.count_distinct("timestamp")).first()
    assert n == distinct == 31 * 1440 + 1
    assert total == 1000000000


def test_start_after_end_is_one_slice(spark):
    assert slices(spark, "22:12:00", "22:11:00", "22:15:16") == [("22:12:00", 999, 99)]


def test_sum_is_kept(spark, sf_dir):
    from workload.views import view
    flows = view(spark, sf_dir, "fx_flow")
    out = split_flows(flows, "arrival").groupBy("event_id").agg(F.sum("bytes").alias("b"), F.sum("pkts").alias("p"))
    assert out.join(flows, "event_id").filter("b <> bytes or p <> pkts").count() == 0
    assert out.count() == flows.count()


def test_duration(spark):
    df = spark.sql(f"select {at('22:12:27')}L as t, {at('22:10:50')}L as f, {at('22:15:00')}L as n")
    d = lambda t, f: df.select(flow_duration(t, f, F.col("n"))).first()[0]
    none = F.lit(None).cast("bigint")
    assert d(F.col("t"), F.col("f")) == 97
    assert d(F.col("t"), none) == 0
    assert d(none, none) == 0
    assert d(F.col("f"), F.col("t")) == 1
