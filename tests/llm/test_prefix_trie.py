"""The prefix trie against a trie built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from flowloom.llm import prefix_trie
from flowloom.llm.catalog import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def turn_order(row):
    """Null turns first; within a turn the two hashes of role and text."""
    _, turn, role, text = row
    r, t = (role or "").encode(), (text or "").encode()
    x = xxhash.xxh64_intdigest(t, xxhash.xxh64_intdigest(r, 42))
    y = xxhash.xxh64_intdigest(r, xxhash.xxh64_intdigest(t, _int_seed(5)))
    return (turn is not None, turn or 0, signed(x), signed(y))


def _int_seed(value):
    """xxhash64 of a 32-bit integer with seed 42, as Spark's hash of several columns starts."""
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), 42)


def by_hand(rows):
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=turn_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + turns[h:] if c % 5 else turns
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        key = ()
        members[key].append(c)
        for turn in turns:
            key = (hash(key), turn)
            members[key].append(c)
        ends[key].append(c)
    children, parent, depth = defaultdict(list), {}, {(): 0}
    for turns in whole.values():
        key = ()
        for d, turn in enumerate(turns, 1):
            up, key = key, (hash(key), turn)
            if key not in parent:
                parent[key], depth[key] = up, d
                children[up].append(key)
    out, below = [], {}
    for key in sorted(members, key=lambda k: -depth[k]):
        leaves = sum(below[x][0] for x in children[key]) if children[key] else 1
        saved = (len(members[key]) - 1) * (len(key[1][1].encode()) if key else 0) + sum(below[x][1] for x in children[key])
        below[key] = leaves, saved
        listed = ",".join(map(str, sorted(ends[key])))
        out.append((min(members[key]), depth[key], min(members[parent[key]]) if key else None, len(members[key]), len(children[key]), leaves, saved,
                    hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, tmp_path, **more):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "depth", "a", "b", "x", "len", "at", "part", "bytes"):  # names that the operator uses
        frame = frame.selectExpr("*", f"'z' as `{name}`")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    result = prefix_trie.prefix_trie(spark.read.parquet(f"{tmp_path}/conversations.parquet"), **more) if more else QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    assert result.columns == COLUMNS
    return sorted(map(tuple, result.collect()), key=str)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        if rng.random() < 0.15:
            continue
        base = rng.choice([None, None, 1, 2])
        for t in range(rng.randint(1, 9)):
            said = random.Random(f"{base}{t}").choice("abc") if base and t < 6 else rng.choice(["x", "y", "é" * 3, "", None, "long " * 9])
            rows.append((c, t, rng.choice(["user", "user", None]) if base is None else "user", said))
    return rows


def test_small_conversations(spark, tmp_path):
    rows = conversations(1)
    assert found(spark, rows, tmp_path) == by_hand(rows)


@pytest.mark.parametrize("band", [2, 3, 16])
def test_long_conversations_in_bands(spark, tmp_path, band):
    rng = random.Random(2)
    long_one = [rng.choice("ab") for _ in range(130)]
    rows = conversations(3, 30)
    for c, cut in ((100, 130), (101, 90), (103, 90), (104, 130), (105, 40), (107, 33), (110, 130)):
        rows += [(c, t, "user", long_one[t] if t < cut else rng.choice("cd")) for t in range(rng.randint(cut, 130))]
    assert found(spark, rows, tmp_path, band=band) == by_hand(rows)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(None, 0, "user", "lost"), (10, None, "user", "first"), (10, 0, None, None), (10, 0, None, None), (10, 1, "b", "tie"), (10, 1, "a", "tie"), (10, 1, "a", "other"),
            (11, 0, "user", "short"), (12, 5, "user", "no head " * 3000), (16, 0, "user", "no donor"), (16, 1, "user", "no donor")]
    rows += [(50 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)]  # a group of copies with most rows
    assert found(spark, rows, tmp_path) == by_hand(rows)


def test_one_conversation_over_many_parts(spark, tmp_path):
    """A conversation that holds most rows is split, and read back in order."""
    rows = [(5, t, "user", f"t{t % 7}") for t in range(600)] + [(6, t, "user", f"t{t % 7}") for t in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        slim, groups = prefix_trie.positions(prefix_trie.slim_turns(frame))
        assert groups.where("c = 5").count() > 1
        assert found(spark, rows, tmp_path) == by_hand(rows)
    finally:
        spark.conf.set(setting, before)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_prefix_trie"](spark, sf_dir).collect()), key=str) == by_hand(rows)
