"""Near copies by exact Jaccard similarity: texts whose sets of five-word shingles are at least 4/5 alike are linked.

* Shingles are 64-bit hashes of five lower-cased words (of the whole text if it has fewer). Rows with equal sets share a node. One pass over the
  texts yields a node's SimHash fingerprint, parity sketch and MinHash band keys.
* Candidates, each linear in the number of nodes:
  - SimHash: the generalised pigeonhole search of ``simhash.py`` over the nodes' fingerprints gives tree edges of those within 4 bits. At a similarity of
    0.8 fingerprints differ in about 8 bits, out of that search's reach, hence
  - MinHash: ``BANDS`` keys of ``ROWS`` minima each. Two sets that are 4/5 alike share no key with a probability of (1 - 0.8^ROWS)^BANDS = 5e-5.
    Under a key every member is compared with two leaders, the nodes nearest to and farthest from the key's own bits, so no pairs within
    a key are made. Leaders differ from key to key; in ``ROUNDS`` rounds they are chosen anew, for members not yet linked to them.
  - The rest: pairs under a key that met no leader and are in different groups after those rounds are all held against each other, keys of
    more than ``FEW`` nodes in blocks of ``BLOCK``, by size and parity sketch. This is quadratic in the nodes of such a key, but only pairs left open are kept.
* Every link is verified by the size of the intersection of the two sets. Before that, parity sketches (eight bits or more a shingle, so
  that few differences cancel out) rule pairs out: they differ in at most as many bits as the sets in shingles, which is (n + m) / 9 at most for a link.

Links are exact; groups may miss one only where two texts share no key at all (the probability above; recall measured in the tests
against brute force, and stated in the README). Stored tables of a round are deleted once the next is written.

Keys under which very many nodes lie get their leaders by a broadcast of at most ``HUBS`` rows, the others by a shuffle.

Defined results: null and blank texts have the empty set and are one group; repeated rows share a node; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import release, slices, store
from flowloom.llm.components import connected_components
from flowloom.llm.simhash import near_edges

SHINGLE = 5
#: MinHash keys of a set and minima in each, rounds of leaders, keys by broadcast, members from which a key may be one, size of the sieve of texts.
BANDS, ROWS, ROUNDS, HUBS, HUB_LEAST, SIEVE_BITS = 25, 5, 3, 500, 1000, 20
#: Slots of a sketch for each shingle. Of two sets at a similarity of 0.75, one slot a shingle hides so many differences that half of such pairs stay open.
SPREAD = 8
#: Nodes of a key whose open pairs one join makes, and of a block where there are more.
FEW, BLOCK = 64, 2000
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers, one per minimum.
FACTORS = np.random.default_rng(8).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 2048


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 42)
        return value


def shingles(text: str | None, known: dict | None = None) -> np.ndarray:
    """The sorted set of a whole text's shingle hashes."""
    found = (text or "").lower().encode("utf-8", "surrogatepass").split()
    n = len(found)
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), 42)] if n else [], np.uint64)
    known = _Words() if known is None else known
    h = np.fromiter((known[w] for w in found), np.uint64, n)
    out = np.zeros(n - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        out = (out ^ h[i:n - SHINGLE + 1 + i]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _node(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes())


def sketch(own: np.ndarray) -> bytes:
    """Parities of the set over hash slots; ``SPREAD`` bits a shingle up to the next power of two, between 64 and 65 536."""
    width = 1 << min(16, max(6, (SPREAD * len(own) - 1).bit_length()))
    slots = (own * MIX >> np.uint64(48)).astype(np.int64) & width - 1
    return np.packbits(np.bincount(slots, minlength=width) & 1 == 1, bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, shingles: int) -> bool:
    """Whether two sketches leave it open that sets of so many shingles together are 4/5 alike."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2:]
    return 9 * int(np.bitwise_count(a ^ b).sum(dtype=np.int64)) <= shingles


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (part for batch in batches for part in slices(batch, "x")):
        sizes = (part.column("size_a").to_numpy() + part.column("size_b").to_numpy()).tolist()
        keep = [may_link(x, y, n) for x, y, n in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), sizes, strict=True)]
        yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def band_keys(own: np.ndarray) -> np.ndarray:
    """The MinHash keys of a set; none for the empty one."""
    if not len(own):
        return own
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(own), CHUNK):
        least = np.minimum(least, (own[i:i + CHUNK, None] * FACTORS[None, :]).min(axis=0))
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * MIX
        key ^= key >> np.uint64(29)
    return key


def majority(own: np.ndarray) -> int:
    """The SimHash fingerprint of a set: bits set in more than half of its shingles."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(own), 1 << 15):
        part = own[i:i + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(own), bitorder="little").view(np.int64)[0])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Words()
    for part in (part for batch in batches for part in slices(batch, "text")):
        sets = [shingles(t.as_py(), known) for t in part.column("text")]
        nodes = np.array([_node(own) for own in sets], np.uint64).view(np.int64)
        keys = [band_keys(own).view(np.int64) for own in sets]
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("mark"), pa.array(nodes), pa.array([len(own) for own in sets], pa.int32()), pa.array([sketch(own) for own in sets], pa.binary()),
             pa.array([majority(own) for own in sets], pa.int64()), bands],
            names=["id", "mark", "node", "size", "sketch", "fp", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Words()
    for batch in batches:
        for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
            own = shingles(text.as_py(), known).view(np.int64)
            whole = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(own))
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), whole], names=["node", "own"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text")


def _among(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value[batch.column("mark").to_numpy() & (1 << SIEVE_BITS) - 1]))
    return run


def sets_of(nodes: DataFrame, firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, own) of ``nodes``. A sieve of fixed size keeps most other texts out of the shuffle."""
    wanted = store(nodes.join(firsts, "node").select("node", F.col("x.none").alias("none"), F.coalesce("x.id", F.lit(0).cast("long")).alias("id"), F.col("x.mark").alias("mark")), "wanted")
    slots = wanted.select(F.col("mark").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)).alias("slot")).distinct().toArrow()  # at most 2^SIEVE_BITS rows
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[slots.column("slot").to_numpy()] = True
    texts = rows.select(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), "mark", "text")
    texts = texts.mapInArrow(_among(rows.sparkSession.sparkContext.broadcast(sieve)), texts.schema)
    texts = texts.join(wanted, ["none", "id", "mark"]).dropDuplicates(["none", "id", "mark"])
    sets = store(texts.select("node", "text").mapInArrow(_sets, "node long, own array<long>"), "sets")
    release(wanted)
    return sets


def verified(pairs: DataFrame, firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are at least 4/5 alike."""
    left, right = (firsts.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("sketch").alias(s)) for n, s in (("a", "x"), ("b", "y")))
    asked = store(pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "x", "y").mapInArrow(_open, "a long, b long"), "open")
    sets = sets_of(asked.select("a").union(asked.select("b")).distinct().toDF("node"), firsts, rows)
    left, right = sets.select(F.col("node").alias("a"), F.col("own").alias("x")), sets.select(F.col("node").alias("b"), F.col("own").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = store(asked.join(left, "a").join(right, "b").where(9 * both >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), "links")
    release(asked, sets)
    return links


def simhash_pairs(firsts: DataFrame) -> DataFrame:
    """(a, b): nodes with one fingerprint, and tree edges between nodes whose fingerprints are within 4 bits."""
    owners = store(firsts.groupBy("fp").agg(F.min("node").alias("owner")), "owners")
    edges = near_edges(owners.select("fp"))
    ends = [owners.select(F.col("fp").alias(c), F.col("owner").alias(f"owner_{c}")) for c in ("a", "b")]
    near = edges.join(ends[0], "a").join(ends[1], "b").select("owner_a", "owner_b")
    return _ordered(near.union(firsts.join(owners, "fp").select("node", "owner")))


def shared_keys(slim: DataFrame) -> DataFrame:
    """(key, node): the MinHash keys that several nodes have."""
    rows = slim.select("node", F.explode("bands").alias("key"))
    several = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    return store(rows.join(several, "key").distinct(), "keys")


def leader_pairs(own: DataFrame, turn: int) -> DataFrame:
    """(a, b): every member of ``own`` (key, node, root) with its key's two leaders, where they are not linked yet."""
    mix = F.xxhash64("key", F.lit(turn))
    own = own.withColumn("near", F.col("node").bitwiseXOR(mix))
    leaders = own.groupBy("key").agg(F.min("near").alias("lo"), F.max("near").alias("hi"), F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    leaders = store(leaders.select("key", F.col("lo").bitwiseXOR(mix).alias("lo"), F.col("hi").bitwiseXOR(mix).alias("hi"), "n"), "leaders")
    limit = max(HUB_LEAST, (leaders.agg(F.sum("n")).first()[0] or 0) // HUBS)
    hubs = F.broadcast(leaders.where(F.col("n") > limit).select("key", F.col("lo").alias("hub_lo"), F.col("hi").alias("hub_hi")))
    split = own.join(hubs, "key", "left")
    near = split.where("hub_lo is not null").select("node", F.col("hub_lo").alias("lo"), F.col("hub_hi").alias("hi"))
    rest = split.where("hub_lo is null").select("key", "node").join(leaders.where(F.col("n") <= limit), "key").select("node", "lo", "hi")
    found = near.union(rest)
    return _ordered(found.select("node", "lo").union(found.select("node", "hi")))


def _folded(sketches: list[bytes], rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches of ``rows`` in ``width`` words each: halves laid over one another keep every parity."""
    out = np.zeros((len(rows), width), np.uint64)
    for own, row in zip(out, rows.tolist(), strict=True):
        own[:] = np.bitwise_xor.reduce(np.frombuffer(sketches[row], np.uint64).reshape(-1, width), axis=0)
    return out


def _open_in_blocks(table: pa.Table) -> pa.Table:
    """The pairs (a, b) of two blocks of one key that may link and are in different groups; each pair of nodes once."""
    block, node, root, size = (table.column(c).to_numpy() for c in ("block", "node", "root", "size"))
    sketches = table.column("sketch").to_pylist()
    widths = np.array([len(x) // 8 for x in sketches])
    first = np.flatnonzero(block == table.column("i")[0].as_py())
    second = np.flatnonzero(block == table.column("j")[0].as_py())
    same = table.column("i")[0] == table.column("j")[0]
    found = []
    for width in np.unique(widths):  # sets whose sizes are 4/5 alike have sketches of one width or of two neighbouring ones
        near = np.flatnonzero((widths == width) | (widths == 2 * width))
        words = _folded(sketches, near, width)
        at_word = np.zeros(len(widths), np.int64)
        at_word[near] = np.arange(len(near))
        for at in np.intersect1d(first, near):
            others = second[(widths[second] == width) | (widths[second] == 2 * width) & (widths[at] == width)]
            may = others[(root[others] != root[at]) & (5 * np.minimum(size[others], size[at]) >= 4 * np.maximum(size[others], size[at]))]
            if same:
                may = may[may > at]
            for k in range(0, len(may), CHUNK):
                part = may[k:k + CHUNK]
                differ = np.bitwise_count(words[at_word[part]] ^ words[at_word[at]]).sum(axis=1, dtype=np.int64)
                part = part[9 * differ <= size[part] + size[at]]
                found.append(np.stack([np.minimum(node[part], node[at]), np.maximum(node[part], node[at])]))
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(both[0], pa.int64()), "b": pa.array(both[1], pa.int64())})


def open_pairs(keys: DataFrame, firsts: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(a, b): all pairs under a key that are in different groups and may link."""
    own = keys.withColumn("root", F.col("node")) if roots is None else keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = store(own, "own")
    # of up to three nodes two are leaders, so all pairs have been tested
    mixed = own.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    mixed = mixed.select("key", "n") if roots is None else mixed.where("n > 3").select("key", "n")
    own = own.join(mixed, "key").join(firsts.select("node", F.col("size").cast("long").alias("size"), "sketch"), "node")
    own = store(own.select("key", "n", "node", "root", "size", "sketch"), "members")
    few = own.where(F.col("n") <= FEW)
    left, right = (few.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "size")], F.col("sketch").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    near = left.join(right, "key").where("node_a < node_b and root_a <> root_b and 5 * least(size_a, size_b) >= 4 * greatest(size_a, size_b)")
    near = near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "size_a", "size_b", "x", "y").mapInArrow(_open, "a long, b long")
    many = own.where(F.col("n") > FEW).withColumn("parts", F.ceil(F.col("n") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    many = many.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    blocks = many.select("key", "i", "j", "block", "node", "root", "size", "sketch").groupBy("key", "i", "j").applyInArrow(_open_in_blocks, "a long, b long")
    return near.union(blocks).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    one, two = pairs.columns
    return pairs.where(F.col(one) != F.col(two)).select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The pairs whose nodes are in different groups so far."""
    if roots is None:
        return pairs
    for c in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def node_roots(slim: DataFrame, firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) for every node that is linked to another."""
    keys = shared_keys(slim)
    tested = edges = roots = None
    for turn in range(ROUNDS):
        own = keys.withColumn("root", F.col("node")) if roots is None else keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = _apart(leader_pairs(own, turn), roots)
        if turn == 0:
            pairs = pairs.union(simhash_pairs(firsts))
        pairs = pairs.distinct() if tested is None else pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        if pairs.isEmpty():
            break
        new = verified(pairs, firsts, rows)
        tested = pairs if tested is None else tested.union(pairs)
        if new.isEmpty():
            continue
        edges = new if roots is None else new.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        earlier, roots = roots, store(connected_components(edges), "linked")
        release(earlier, new)
    pairs = open_pairs(keys, firsts, roots)
    pairs = store(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty() and not (new := verified(pairs, firsts, rows)).isEmpty():
        edges = new if roots is None else new.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = store(connected_components(edges), "linked")
    release(keys)
    return roots if roots is not None else slim.sparkSession.createDataFrame([], "node long, root long")


def first_of_groups(docs: DataFrame) -> DataFrame:
    """(id, mark) of the row with the smallest id of each group of near copies; a null id only where the group has no other."""
    rows = _texts(docs)
    slim = store(rows.mapInArrow(_nodes, "id long, mark long, node long, size int, sketch binary, fp long, bands array<long>"), "nodes")
    firsts = store(slim.groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("x"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("fp").alias("fp")), "firsts")
    roots = node_roots(slim, firsts, rows)
    release(slim)
    return firsts.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("x").alias("x")).select("x.id", "x.mark")
