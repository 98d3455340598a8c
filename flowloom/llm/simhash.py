"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit set where more than half of the text's shingle hashes (XXH64, seed 42) have it. Fingerprints at
``radius`` or fewer differing bits are linked.

* Bits are put into m partitions, correlated bits together; partition i gets a threshold t_i with sum(t_i + 1) = radius + 1
  (a threshold of -1 leaves a partition out). Two linked fingerprints must differ in at most t_i bits of some partition.
  Correlations and candidate counts are estimated on ``SAMPLE`` fingerprints (the smallest by hash); dynamic programming
  finds the cheapest thresholds for each m, and the cheapest m is used. The sample steers the cost, never the result.
* Probe: distinct fingerprints are written under one key for each way to blank t_i bits of partition i; fingerprints within t_i
  bits there share a key.
* Verify: the fingerprints of a key are searched breadth-first from the smallest one: whatever the frontier reaches within
  the radius leaves the unvisited set, so a dense group costs little more than one pass, and only tree edges come out, never all
  pairs. Above ``LINEAR_FROM`` unvisited members the search goes by midpoints instead: fingerprints within 4 bits share a value
  within 2 bits of both, so members and their 2 081 neighbours form a graph with the same components, at linear cost.
* Components of the tree edges give each fingerprint, and through it each document, the smallest id it reaches.

Defined results: null and blank texts have fingerprint zero and are linked like any other; repeated rows share a
fingerprint; null ids are ignored when a group's smallest id is chosen, unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store
from flowloom.llm.components import connected_components

WIDTH, RADIUS, SHINGLE = 64, 4, 4
#: Fingerprints for estimates; a probe row's cost against that of a candidate pair.
SAMPLE, PROBE_COST, PAIR_COST = 4096, 6.0, 1.0
#: Runs of a key up to this length are compared in one vector step; bucket size from which midpoints are used.
SHORT, LINEAR_FROM = 8, 1 << 17
MIDPOINT_CHUNK = 1 << 11


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    if n <= shingle:
        pieces = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        pieces = [joined[a:b] for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, 42) for p in pieces), np.uint64, len(pieces))
    counts = np.zeros(WIDTH, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i:i + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(values)], names=["id", "mark", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, fp): ``mark`` is a hash of the text, which tells rows of one id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints, "id long, mark long, fp long")


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the bit positions, each grown from its most correlated pair; ``bits`` is a 0/1 sample matrix."""
    if len(bits) > 1:
        with np.errstate(invalid="ignore", divide="ignore"):
            corr = np.nan_to_num(np.abs(np.corrcoef(bits.T)))
    else:
        corr = np.zeros((WIDTH, WIDTH))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(WIDTH)), []
    for g in range(m):
        room = len(free) // (m - g)
        pair = max(combinations(free, 2), key=lambda p: corr[p])
        group = [*pair]
        free = [b for b in free if b not in group]
        while len(group) < room:
            best = max(free, key=lambda b: corr[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(groups: list[list[int]], sample: np.ndarray, n: int, radius: int = RADIUS) -> tuple[float, list[int]]:
    """Cheapest thresholds for the partitions by dynamic programming: (cost, thresholds), sum(t + 1) = radius + 1."""
    a, b = sample[: len(sample) // 2], sample[len(sample) // 2:]
    n = max(n, 2)  # with nothing to find every plan would cost the same, large ones too
    pairs = n * n / 2
    plans: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        mask = np.uint64(sum(1 << x for x in group))
        bits = ((sample[:, None] & mask) >> np.array(group, np.uint64)[None, :] & np.uint64(1)).mean(axis=0) if len(sample) else np.full(len(group), 0.5)
        equal = float(np.prod(bits ** 2 + (1 - bits) ** 2))  # were the bits independent
        near = np.zeros(radius + 1)
        for i in range(0, len(a), 512):
            near += np.bincount(np.bitwise_count((a[i:i + 512, None] ^ b[None, :]) & mask).ravel(), minlength=WIDTH + 1)[: radius + 1]
        seen = np.cumsum(near) / max(1, len(a) * len(b))
        costs = [0.0]
        for t in range(radius + 1):
            ball = sum(comb(len(group), k) for k in range(t + 1))
            costs.append(PAIR_COST * pairs * max(seen[t], equal * ball) + PROBE_COST * n * comb(len(group), t))
        plans = {
            spent: min((cost + costs[s], [*ts, s - 1]) for done, (cost, ts) in plans.items() for s in [spent - done] if 0 <= s <= radius + 1)
            for spent in range(radius + 2) if any(0 <= spent - done <= radius + 1 for done in plans)
        }
    return plans[radius + 1]


def probe_masks(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[int]:
    """The masks under which fingerprints are written, from the cheapest number of partitions."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(len(sample), 8), axis=1, bitorder="little").astype(float)
    best = None
    for m in range(2, radius + 2):
        groups = group_bits(bits, m)
        cost, thresholds = allocate(groups, sample, n, radius)
        if best is None or cost < best[0]:
            best = (cost, groups, thresholds)
    masks = []
    for group, t in zip(best[1], best[2], strict=True):
        for blank in combinations(group, t) if t >= 0 else []:
            masks.append(sum(1 << x for x in group if x not in blank))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _midpoints(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges over which the members have the same components as at 4 bits, through shared values within 2 bits."""
    masks = [0, *(1 << i for i in range(WIDTH)), *((1 << i) | (1 << j) for i, j in combinations(range(WIDTH), 2))]
    masks = np.array(masks, np.uint64)
    heads, tails = [], []
    rounds = max(1, len(members) // MIDPOINT_CHUNK)
    for r in range(rounds):  # the shared values in turns, so memory stays bounded
        keys, owners = [], []
        for mask in masks:
            value = members ^ mask
            mine = np.flatnonzero((value * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(rounds) == r)
            keys.append(value[mine])
            owners.append(mine)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], members[owner[order]]
        same = np.flatnonzero(key[1:] == key[:-1])
        link = np.unique(np.stack([np.minimum(owner[same], owner[same + 1]), np.maximum(owner[same], owner[same + 1])], axis=1), axis=0)
        heads.append(link[:, 0])
        tails.append(link[:, 1])
    return np.concatenate(heads), np.concatenate(tails)


def bucket_edges(members: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Tree edges (root, member) among one key's distinct fingerprints: same components as all links within the radius."""
    if len(members) > LINEAR_FROM and radius == 4:
        return _midpoints(members)
    left, heads, tails = members, [], []
    while len(left) > 1:
        root, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            reached = np.zeros(len(left), bool)
            block = max(1, (1 << 20) // len(left))
            for i in range(0, len(frontier), block):
                reached |= (np.bitwise_count(frontier[i:i + block, None] ^ left[None, :]) <= radius).any(axis=0)
            frontier, left = left[reached], left[~reached]
            heads.append(np.full(len(frontier), root, np.uint64))
            tails.append(frontier)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (members[:0], members[:0])


def _edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_key = kept_fp = np.zeros(0, np.int64)

        def found(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            lengths = np.diff(cuts)
            run_left = np.repeat(cuts[1:], lengths) - np.arange(len(key))  # rows of the key from here on
            short = np.repeat(lengths <= SHORT, lengths)
            fp = fp.view(np.uint64)
            heads, tails = [], []
            for step in range(1, SHORT):
                at = np.flatnonzero(short & (run_left > step))
                if not len(at):
                    break
                near = np.bitwise_count(fp[at] ^ fp[at + step]) <= radius
                heads.append(fp[at[near]])
                tails.append(fp[at[near] + step])
            for i in np.flatnonzero(lengths > SHORT):
                h, t = bucket_edges(np.unique(fp[cuts[i]:cuts[i + 1]]), radius)
                heads.append(h)
                tails.append(t)
            if heads:
                a, b = np.concatenate(heads).view(np.int64), np.concatenate(tails).view(np.int64)
                link = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(link[:, 0]), pa.array(link[:, 1])], names=["a", "b"])

        for batch in batches:
            key = np.concatenate((kept_key, batch.column("key").to_numpy(zero_copy_only=False)))
            fp = np.concatenate((kept_fp, batch.column("fp").to_numpy(zero_copy_only=False)))
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on in the next batch
            kept_key, kept_fp = key[last:].copy(), fp[last:].copy()
            if last:
                yield from found(key[:last], fp[:last])
        if len(kept_key):
            yield from found(kept_key, kept_fp)
    return run


def near_edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Tree edges (a, b) among distinct fingerprints (fp; a stored table), with the components of all links within the radius."""
    n = distinct.count()
    sample = [r[0] for r in distinct.orderBy(F.xxhash64("fp"), "fp").select("fp").limit(SAMPLE).collect()]  # at most SAMPLE values
    masks = probe_masks(np.array(sample, np.int64).view(np.uint64), n, radius)
    ways = F.array(*[F.struct(F.lit(i).alias("way"), F.lit(_signed(x)).cast("long").alias("mask")) for i, x in enumerate(masks)])
    probes = distinct.select("fp", F.explode(ways).alias("w")).select(F.xxhash64("w.way", F.col("fp").bitwiseAND(F.col("w.mask"))).alias("key"), "fp")
    return probes.repartition("key").sortWithinPartitions("key").mapInArrow(_edges(radius), "a long, b long")


def near_components(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``fps`` (id, fp; a stored table)."""
    distinct = store(fps.groupBy("fp").agg(F.min("id").alias("first_id")), "fps")
    roots = connected_components(near_edges(distinct, radius))
    rooted = store(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "roots")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(id, mark, fp, component_id), one row per document."""
    fps = store(fingerprints(docs), "fingerprints")
    return fps.join(near_components(fps, radius), "fp")


def only_rows(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The columns of ``docs``; only the rows (id, mark) of ``first`` stay, each once."""
    # one key without nulls for the join and the removal of equal rows, so that the texts are shuffled once
    own = {"__none": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__own": F.xxhash64("text")}
    keepers = first.select(F.col("id").isNull().alias("__none"), F.coalesce("id", F.lit(0).cast("long")).alias("__id"), F.col("mark").alias("__own"))
    return docs.withColumns(own).join(keepers, list(own), "left_semi").dropDuplicates(list(own)).drop(*own)


@query("op8_simhash")
def op8_simhash(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")
