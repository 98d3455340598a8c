"""The trie of conversation prefixes, rolled up in bands of fixed height.

1. Turns become slim rows: two hashes of (role, text) and the text's size. They are range-partitioned by conversation and turn (sampled
   splitters), so a conversation that holds a third of all rows lies in many tasks; positions are places within a (conversation, part) group plus
   the sizes of the conversation's earlier groups.
2. Rebuilt: the head of the conversation's block (at most ``HEAD_MOST`` turns, to at most ``BLOCK`` conversations), then its own tail.
3. A prefix is named by two 64-bit lanes: the exclusive-or, over its turns, of hashes of (position, turn). Running values are taken within a group,
   groups hand on their totals. Without a turn's own lanes a prefix's name is its parent's.
4. Nodes are an aggregate over all prefixes; the smallest member and the depth name a node as well.
5. Roll-up. What a node adds (leaf, saved bytes) lies on the path of its smallest member. Within a band of ``BAND`` depths the sums from below along
   that path explode to the node's ancestors in the band, at most ``BAND`` rows, and are added up by name. Band roots form a trie that is ``BAND``
   times lower; it is rolled up first, by the same steps, and its completed totals enter the band above at the root's parent. So a chain of n turns
   takes log(n) / log(BAND) rounds, and no node explodes beyond its band.
6. The hash of the members that end at a node needs them in order: sorted ranges write them as pieces, one streaming pass per node
   digests the pieces.

Names have 128 bits; that two different prefixes share one is ruled out for practical purposes only. Nothing but the depth of the trie and two counts
reaches the driver. Parents with very many children are joined by a broadcast of at most ``HUBS`` rows, the others by a shuffle.

Defined results: rows without conv_id belong to no conversation; a null role or text is empty; turns are ordered with null first, rows of one
turn by the hash of role and text; repeated rows are turns of their own; negative ids belong to the block below; an empty table gives an
empty result (not even a root); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, release, store

#: Heads are shared by blocks of BLOCK ids; a head has fewer than HEAD_MOST + 1 turns.
BLOCK, HEAD_MOST = 5, 8
BAND, HUBS, HUB_LEAST = 16, 500, 1000
KEY = ["depth", "a", "b"]


def slim_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turn, x, y, bytes): conversation, order, two hashes of (role, text), UTF-8 bytes of the text."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("x"), F.xxhash64(F.lit(BLOCK), t, r).alias("y"),
        F.octet_length(t).cast("long").alias("bytes"))


def positions(slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with ``at`` and ``part``, groups (c, part, first, offset, n)): a row's position is at - first + offset + 1."""
    order = ["c", "turn", "x", "y"]
    rows = store(slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    groups = rows.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy("c")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, groups.select("c", "part", "first", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset"), F.sum("own").over(whole).alias("n"))


def head_turns(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary")) % (HEAD_MOST + 1)


def rebuilt(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns (c, part, depth, x, y, bytes, len), conversations (c, len)); part -1 holds the turns taken from another conversation."""
    sizes = groups.groupBy("c").agg(F.first("n").alias("n"))
    donor = F.col("c") - F.pmod("c", F.lit(BLOCK))
    heads = sizes.where(F.pmod("c", F.lit(BLOCK)) == 0).select(F.col("c").alias("donor"), F.col("n").alias("n_donor"))
    h = F.when(F.col("c") == F.col("donor"), 0).otherwise(head_turns(F.col("c")))
    convs = sizes.withColumn("donor", donor).join(heads, "donor", "left").select("c", "donor", "n", h.alias("h"), F.least(h, F.coalesce("n_donor", F.lit(0))).alias("k"))
    convs = store(convs.withColumn("len", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "convs")
    shape = groups.select("c", "part", "first", "offset").join(convs.select("c", "h", "k", "len"), "c")
    placed = rows.join(shape, ["c", "part"]).withColumn("p", F.col("at") - F.col("first") + F.col("offset") + 1)
    own = placed.where("p > h").select("c", "part", (F.col("k") + F.col("p") - F.col("h")).alias("depth"), "x", "y", "bytes", "len")
    given = placed.where((F.col("p") <= HEAD_MOST) & (F.pmod("c", F.lit(BLOCK)) == 0)).select(F.col("c").alias("donor"), F.col("p").alias("depth"), "x", "y", "bytes")
    taken = given.join(convs.where("c <> donor and k > 0").select("donor", "c", "k", "len"), "donor").where("depth <= k")
    return own.union(taken.select("c", F.lit(-1).cast("long").alias("part"), "depth", "x", "y", "bytes", "len")), convs.select("c", "len")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, depth, a, b, pa, pb, bytes, len): every prefix of every conversation, the empty one too, with its parent's name."""
    lanes = turns.select("c", "part", "depth", F.xxhash64("depth", "x", "y").alias("la"), F.xxhash64("y", "depth", "x").alias("lb"), "bytes", "len")
    so_far = Window.partitionBy("c", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = store(lanes.withColumns({"ra": F.bit_xor("la").over(so_far), "rb": F.bit_xor("lb").over(so_far)}), "local")
    totals = local.groupBy("c", "part").agg(F.bit_xor("la").alias("ta"), F.bit_xor("lb").alias("tb"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("c", "part", *[F.coalesce(F.bit_xor(t).over(earlier), F.lit(0).cast("long")).alias(n) for t, n in (("ta", "ca"), ("tb", "cb"))])
    a, b = F.col("ra").bitwiseXOR(F.col("ca")), F.col("rb").bitwiseXOR(F.col("cb"))
    named = local.join(carry, ["c", "part"]).select(
        "c", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("la")).alias("pa"), b.bitwiseXOR(F.col("lb")).alias("pb"), "bytes", "len")
    zero = F.lit(0).cast("long")
    paths = store(named.union(convs.select("c", zero, zero, zero, zero, zero, zero, "len")), "prefixes")
    release(local)
    return paths


def subtree_sums(rows: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """(depth, a, b, c, leaves, saved): sums over each node's subtree of what the rows (c, depth, a, b, leaves, saved) add;
    ``c`` is a conversation through the node."""
    added = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    if deepest >= band:
        of_band = F.floor(F.col("depth") / band).cast("long")
        at_root = F.col("depth") % band == 0
        upper = rows.groupBy("c", of_band.alias("up")).agg(*[F.max(F.when(at_root, F.col(k))).alias(k) for k in ("a", "b")], *added).withColumnRenamed("up", "depth")
        totals = subtree_sums(store(upper, "bands"), deepest // band, band)
        none = F.lit(None).cast("long")
        carried = totals.where("depth > 0").select("c", (F.col("depth") * band - 1).alias("depth"), none.alias("a"), none.alias("b"), "leaves", "saved")
        rows = rows.select("c", "depth", "a", "b", "leaves", "saved").union(carried)
        below = Window.partitionBy("c", of_band).orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        below = Window.partitionBy("c").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    up = rows.select("c", "depth", "a", "b", F.sum("leaves").over(below).alias("leaves"), F.sum("saved").over(below).alias("saved"))
    return up.where("a is not null and (leaves > 0 or saved > 0)").groupBy(*KEY).agg(F.min("c").alias("c"), *added)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by node and conversation, the ids of each node as text, one piece per node and batch."""
    for batch in batches:
        made: dict[tuple, list[int]] = {}
        for *node, c in zip(*[batch.column(k).to_pylist() for k in (*KEY, "c")], strict=True):
            made.setdefault(tuple(node), []).append(c)
        columns = [pa.array([node[i] for node in made], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([ids[0] for ids in made.values()], pa.int64()), pa.array([",".join(map(str, ids)) for ids in made.values()], pa.string())],
                                         names=[*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by node and first id, each node's SHA-256; a node's pieces are never held together."""
    node, digest = None, None

    def row(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([d[0][i] for d in done], pa.int64()) for i in range(3)], pa.array([d[1] for d in done], pa.string())], names=[*KEY, "ends"])
    for batch in batches:
        done = []
        for *own, ids in zip(*[batch.column(k).to_pylist() for k in (*KEY, "ids")], strict=True):
            if own != node:
                if digest is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield row(done)
    if digest is not None:
        yield row([(node, digest.hexdigest())])


def end_digests(paths: DataFrame) -> DataFrame:
    """(depth, a, b, ends): SHA-256 of the ids, in order, of the conversations that end at a node."""
    ends = paths.where("depth = len").select(*KEY, "c")
    order = [*KEY, "c"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "depth long, a long, b long, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "depth long, a long, b long, ends string")


def _with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``; parents with very many children by a broadcast of at most HUBS rows."""
    limit = max(HUB_LEAST, nodes.count() // HUBS)
    parents = nodes.join(children, KEY).select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hubs = F.broadcast(parents.where(F.col("n_children") > limit).select("depth", "pa", "pb", F.col("parent_conv_id").alias("hub")))
    split = nodes.join(hubs, ["depth", "pa", "pb"], "left")
    near = split.where("hub is not null").withColumnRenamed("hub", "parent_conv_id")
    rest = split.where("hub is null").drop("hub").join(parents.where(F.col("n_children") <= limit).drop("n_children"), ["depth", "pa", "pb"], "left")
    return near.select(*rest.columns).union(rest)


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node."""
    rows, groups = positions(slim_turns(conversations))
    paths = prefixes(*rebuilt(rows, groups))
    nodes = store(paths.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("len") == F.col("depth")).alias("n_ends"),
        F.max("bytes").alias("bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb")), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    own = nodes.select(F.col("conv_id").alias("c"), "depth", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    adds = paths.select("c", *KEY).join(own, ["c", "depth"], "left").fillna(0, ["leaves", "saved"])
    sums = subtree_sums(store(adds, "adds") if deepest >= band else adds, deepest, band).drop("c")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    whole = _with_parents(nodes, children).join(children, KEY, "left").join(sums, KEY, "left").join(end_digests(paths), KEY, "left")
    return whole.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(0)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: CRC-32 of the decimal id is written out bit by bit (reflected polynomial 0xEDB88320). Prefixes are compared by a hash of all their turns.
SQL = """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, c - ((c % 5) + 5) % 5 AS donor FROM t GROUP BY c),
k AS (
  SELECT c, donor, CASE WHEN c = donor THEN 0 ELSE xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda r, byte: list_reduce(range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(r, byte)), 4294967295), 4294967295) % 9 END AS h
  FROM n),
r AS (
  SELECT t.c, least(k.h, coalesce(d.n, 0)) + t.p - k.h AS depth, t.x, t.bytes FROM t JOIN k USING (c) LEFT JOIN n AS d ON d.c = k.donor WHERE t.p > k.h
  UNION ALL SELECT k.c, t.p, t.x, t.bytes FROM k JOIN t ON t.c = k.donor AND t.p <= k.h),
path AS (
  SELECT c, depth, sha256(string_agg(x, '') OVER (PARTITION BY c ORDER BY depth)) AS name, bytes FROM r
  UNION ALL SELECT c, 0, '', 0 FROM n),
sized AS (SELECT *, max(depth) OVER (PARTITION BY c) AS len, lag(name) OVER (PARTITION BY c ORDER BY depth) AS up FROM path),
node AS (
  SELECT depth, name, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = len), '')) AS ends_sha256
  FROM sized GROUP BY depth, name),
child AS (SELECT depth - 1 AS depth, up AS name, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT s.depth, s.name, count(*) FILTER (k.name IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved_tokens
  FROM node AS v JOIN sized AS s ON s.c = v.conv_id AND s.depth <= v.depth LEFT JOIN child AS k ON k.depth = v.depth AND k.name = v.name
  GROUP BY s.depth, s.name)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n_children, 0) AS n_children, below.n_leaves,
  CAST(below.saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (depth, name) LEFT JOIN child USING (depth, name)
LEFT JOIN node AS parent ON parent.depth = node.depth - 1 AND parent.name = node.up
"""


@query("op12_prefix_trie", SQL)
def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(documents(spark, sf_dir, "conversations"))
