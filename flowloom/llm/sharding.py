"""Sharding by sampled splitters.

Records are ordered by a key (here a hash of the text, then the id, so equal texts lie together) and cut into
``shards`` contiguous stretches of near-equal size:

1. a pass over the rows writes the slim columns (id, key, size);
2. rows are drawn with probability in proportion to their size; the quantiles of the drawn keys are the splitters
   of ``ranges`` ranges. Splitters decide only how the work is dealt out, never the result's balance;
3. rows and bytes of every range are counted; a range with more than its share of rows (a hot key) is subdivided
   by a hash of the row, as often as its count asks for;
4. the counts (a small table: one line per piece, about one for 200,000 rows) give each piece its offset, so a running
   sum inside the piece places every row exactly: shard = which eighth of all bytes its first byte falls into.

Defined results: a null text has no bytes (size 1); null ids sort first; repeated rows are placed one by one; an
empty table gives an empty result; other columns travel along untouched when ``keep`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store

SHARDS = 8
#: Splitters are looked up in two steps of FAN each; DRAWS rows are drawn in expectation.
FAN = 64
DRAWS = 16 * FAN * FAN
#: A range is subdivided beyond twice the mean of all ranges, but never within LEAST_ROWS and always beyond MOST_ROWS.
LEAST_ROWS, MOST_ROWS = 256, 200_000


def splitters(df: DataFrame, total: int, ranges: int, draws: int = DRAWS) -> list[int]:
    """Quantile boundaries of keys drawn with probability in proportion to size; at most ``ranges`` - 1."""
    share = F.lit(float(draws)) / F.lit(float(max(total, 1)))
    drawn = df.where(F.rand(17) < F.col("__size") * share).select("__key")
    cuts = [i / ranges for i in range(1, ranges)]
    found = drawn.agg(F.percentile_approx("__key", cuts, 10 * ranges)).first()[0] or []
    return sorted(set(found))


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of splitters at or below the key, found among about FAN coarse and FAN fine ones."""
    if not cuts:
        return F.lit(0)
    rows = [cuts[i:i + FAN] for i in range(0, len(cuts), FAN)]
    heads = F.array(*[F.lit(r[0]) for r in rows])
    fine = F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows])
    coarse = F.size(F.filter(heads, lambda c: c <= key))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda c: c <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * FAN + inside).cast("int")


def keyed(df: DataFrame, key: Column, size: Column, tie: list[Column]) -> DataFrame:
    return df.withColumns({"__key": key, "__size": size, "__tie": F.xxhash64(key, *tie)})


def place(df: DataFrame, slim: DataFrame, tie: list[Column], shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, from 0 in each shard) added.

    Both tables are results of :func:`keyed` over the same stored rows; ``slim`` has only the columns that ``tie`` needs,
    and all counting is done on it, so wide rows are read once.
    """
    spark, wide, df = df.sparkSession, df, slim
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum("__size"), F.lit(0))).first()
    if not rows:
        return wide.drop("__key", "__size", "__tie").select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = ranges or min(FAN * FAN, max(8 * shards, rows // 500))
    cuts = splitters(df, total, ranges)
    cap = min(MOST_ROWS, max(LEAST_ROWS, 2 * rows // ranges))
    counts = df.groupBy(range_of(F.col("__key"), cuts).alias("__range")).agg(F.count("*").alias("n"))
    hot = {r["__range"]: -(-r["n"] // cap) for r in counts.where(F.col("n") > cap).collect()}  # at most `ranges` rows

    def dealt(t: DataFrame) -> DataFrame:
        t = t.withColumn("__range", range_of(F.col("__key"), cuts))
        if not hot:
            return t.withColumn("__part", F.lit(0))
        parts = F.broadcast(spark.createDataFrame(list(hot.items()), "__range int, __parts long"))
        part = F.pmod("__tie", F.coalesce("__parts", F.lit(1).cast("long"))).cast("int")
        return t.join(parts, "__range", "left").withColumn("__part", part).drop("__parts")

    df = dealt(df)
    pieces = df.groupBy("__range", "__part").agg(F.count("*").alias("n"), F.sum("__size").alias("b"))
    pieces = sorted((r["__range"], r["__part"], r["n"], r["b"]) for r in pieces.collect())  # at most 2 * ranges + rows / MOST_ROWS

    def shard_at(byte: int) -> int:
        return byte * shards // total

    offsets, at_row, at_byte, straddling = [], 0, 0, []
    for r, p, n, b in pieces:
        offsets.append((r, p, at_row, at_byte))
        if shard_at(at_byte) != shard_at(at_byte + b):
            straddling.append((r, p))
        at_row, at_byte = at_row + n, at_byte + b
    table = F.broadcast(spark.createDataFrame(offsets, "__range int, __part int, __row long, __byte long"))
    piece = Window.partitionBy("__range", "__part").orderBy("__key", "__tie", *tie)

    def placed(rows_of: DataFrame) -> DataFrame:
        running = F.sum("__size").over(piece.rowsBetween(Window.unboundedPreceding, 0))
        numbered = rows_of.join(table, ["__range", "__part"]).withColumns({
            "__at": F.col("__row") + F.row_number().over(piece) - 1, "__before": F.col("__byte") + running - F.col("__size")})
        return numbered.withColumn("shard", F.expr(f"cast(__before * {shards} div {total} as int)"))

    # the first row of a shard opens a piece, or lies in one of the pieces that straddle a boundary (at most shards - 1)
    starts: dict[int, int] = {}
    for _, _, row, byte in offsets:
        starts.setdefault(shard_at(byte), row)
    edge = F.broadcast(spark.createDataFrame(straddling, "__range int, __part int"))
    for r in placed(df.join(edge, ["__range", "__part"])).groupBy("shard").agg(F.min("__at").alias("at")).collect():
        starts[r["shard"]] = min(r["at"], starts.get(r["shard"], r["at"]))
    starts = {s: starts.get(s, 0) for s in range(shards)}
    first = F.element_at(F.array(*[F.lit(starts[s]).cast("long") for s in range(shards)]), F.col("shard") + 1)
    return placed(dealt(wide)).withColumn("slot", F.col("__at") - first).drop(
        "__key", "__size", "__tie", "__range", "__part", "__row", "__byte", "__at", "__before")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Whole documents with ``shard`` and ``slot``; ``docs`` must be a stored table. Columns of these names are replaced."""
    text = F.coalesce("text", F.lit(""))
    wide = keyed(docs.drop("shard", "slot"), F.xxhash64(text), F.octet_length(text).cast("long") + 1, [F.col("doc_id")])
    slim = store(wide.select("doc_id", "__key", "__size", "__tie"), "sizes")
    return place(wide, slim, [F.col("doc_id")], shards)


@query("op9_sharding")
def op9_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", "text", F.crc32(text.cast("binary")).alias("text_crc32"))
    tie = [F.col("doc_id"), F.col("text_crc32")]
    slim = store(keyed(rows, F.xxhash64(text), F.octet_length(text).cast("long") + 1, tie).withColumn("size", F.col("__size")).drop("text"), "sizes")
    return place(slim, slim, tie).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
