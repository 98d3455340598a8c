"""Benchmark decontamination: short test items are found inside long documents.

Words are lower-cased runs of letters and digits; a shingle is ``SHINGLE`` words. A document contains an item if it has at least
``CONTAINED`` of the item's different shingles. Whole-document signatures cannot see that (40 shingles among 100 000 leave no trace in
a minimum), so the search keeps the minimum hashes of the items and streams the documents past them:

1. Items are partitioned by size, one partition per power of two. In the partition up to u shingles an item's sketch is its
   s = 2 floor((1 - t) u) + 1 smallest shingle hashes (bottom-s MinHash). A document that contains the item misses at most floor((1 - t) q)
   of its q shingles, so it must meet at least s - floor((1 - t) q) >= 1 of the sketch: no true pair is lost, whatever the
   document's size, and hits / s estimates the containment.
2. Each document's different shingle hashes meet the sketches in one equi-join; hits are counted with partial aggregates.
3. Candidate pairs are verified exactly: the candidate documents' shingles, as text, against the items' shingles.

Sketches, item shingles and candidates are broadcast only while a count says that they stay below ``BROADCAST_ROWS`` rows; beyond that
Spark shuffles. Repeated shingles count once.

Defined results: null texts have no shingles; items under ``SHINGLE`` words have none either and match nothing; items with one id are
one item (their shingles together); rows that share an id are judged apart and reported once, with the best containment; an empty
table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store

SHINGLE, CONTAINED = 5, 0.8
BROADCAST_ROWS = 1_000_000
#: Hundredths, so that the pigeonhole bounds are integer arithmetic.
MISSABLE = 100 - round(100 * CONTAINED)


def terms(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _over(words: Column, make) -> Column:
    last = F.size(words) - SHINGLE
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: make([words[i + k] for k in range(SHINGLE)])))


def shingle_hashes(words: Column) -> Column:
    return F.array_distinct(_over(words, lambda parts: F.xxhash64(*parts)))


def shingle_texts(words: Column) -> Column:
    return F.array_distinct(_over(words, lambda parts: F.concat_ws(" ", *parts)))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, shingle, h, q, rank): different shingles of each item, their number and order by hash.

    An item is one row of short text, so exploding and ranking stay within the item.
    """
    words = items.select(F.col(id_col).alias("item_id"), terms(F.col(text_col)).alias("w"))
    each = words.select("item_id", F.explode(shingle_texts(F.col("w"))).alias("shingle")).distinct()
    parts = F.split("shingle", " ")
    hashed = each.select("item_id", "shingle", F.xxhash64(*[parts[k] for k in range(SHINGLE)]).alias("h"))
    listed = hashed.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("h", "shingle"))).alias("all"))
    return listed.select("item_id", F.size("all").cast("long").alias("q"), F.posexplode("all").alias("rank", "s")).select(
        "item_id", "s.shingle", "s.h", "q", "rank")


def sketches(shingles: DataFrame) -> DataFrame:
    """(item_id, h, need): the bottom hashes of each item and how many of them a containing document must meet."""
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.col("q"))) + 1).cast("long")
    size = F.least(F.col("q"), 2 * F.expr(f"({MISSABLE} * u) div 100") + 1)
    missable = F.expr(f"({MISSABLE} * q) div 100")
    return shingles.withColumn("u", upper).where(F.col("rank") < size).select("item_id", "h", (size - missable).alias("need"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, item_id, shared, q) of every document that contains an item; ``mark`` is a hash of the text."""
    shingles = store(item_shingles(items), "items")
    sketch = store(sketches(shingles), "sketches")
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), terms(F.col(text_col)).alias("w"))
    hashes = words.select("id", "mark", F.explode(shingle_hashes(F.col("w"))).alias("h"))
    hits = hashes.join(bounded(sketch, sketch.count()), "h").groupBy("id", "mark", "item_id").agg(F.count("*").alias("n"), F.max("need").alias("need"))
    candidates = store(hits.where("n >= need").select("id", "mark", "item_id"), "candidates")
    pairs = candidates.count()
    keys = bounded(candidates.select(F.col("id").alias("c_id"), F.col("mark").alias("c_mark")).distinct(), pairs)
    suspects = words.join(keys, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")), "left_semi")
    texts = suspects.select("id", "mark", F.explode(shingle_texts(F.col("w"))).alias("shingle"))
    met = texts.join(bounded(shingles.select("shingle", "item_id", "q"), shingles.count()), "shingle")
    wanted = bounded(candidates.select(F.col("id").alias("c_id"), F.col("mark").alias("c_mark"), F.col("item_id").alias("c_item")), pairs)
    same = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")) & F.col("item_id").eqNullSafe(F.col("c_item"))
    exact = met.join(wanted, same, "left_semi").select("id", "mark", "item_id", "q", "shingle").distinct()
    counted = exact.groupBy("id", "mark", "item_id", "q").agg(F.count("*").alias("shared"))
    return counted.where(F.col("shared") * 100 >= F.col("q") * (100 - MISSABLE))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of ``docs`` without the documents that contain an item."""
    found = store(contained_items(docs, items).select(F.col("id").alias("__id"), F.col("mark").alias("__mark")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__mark"))
    return docs.join(bounded(found, found.count()), same, "left_anti")


@query("op3_decontamination", """
with d as (select doc_id, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) as t from documents),
b as (select item_id, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) as t from benchmark),
dw as (select doc_id, string_split(t, ' ') as w from d where t <> ''),
bw as (select item_id, string_split(t, ' ') as w from b where t <> ''),
ds as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from dw)),
bs as (select distinct item_id, array_to_string(w[i:i + 4], ' ') as s from (select item_id, w, unnest(range(1, len(w) - 3)) as i from bw)),
q as (select item_id, count(*) as item_shingles from bs group by item_id)
select doc_id, item_id, count(*) as shared, item_shingles, count(*)::double / item_shingles as containment
from ds join bs using (s) join q using (item_id) group by doc_id, item_id, item_shingles having count(*) * 100 >= item_shingles * 80""")
def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contained_items(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    best = found.groupBy(F.col("id").alias("doc_id"), "item_id").agg(F.max("shared").alias("shared"), F.max("q").alias("item_shingles"))
    return best.select("*", (F.col("shared") / F.col("item_shingles")).alias("containment"))
