"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical after every run of blanks became one space. Only digests are shuffled:

1. one pass over the texts writes (id, digest) to the shared folder;
2. a mergeable frequent-items sketch of the digests (Misra-Gries counters, Spark's ``approx_top_k``)
   names at most ``top`` candidates; any digest with more than about rows / ``tracked`` rows is among the tracked;
3. the candidates are counted exactly, with partial aggregates; those that do repeat are the winners.
   There are at most ``top`` of them, so they are broadcast and their rows never leave the map side;
4. the other digests are grouped and joined back by an ordinary shuffle.

Defined results: a null text counts as empty; a null id sorts after every other id and stays only where the
whole group has null ids; repeated rows form a group like any other, and exactly the rows that carry the
smallest id are kept (``repeats`` false) or, with equal ids, one output row per input row, each ``kept``.
An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store

#: Counters of the sketch and the number of candidates taken from it.
TRACKED, TOP = 8192, 256


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; single spaces are left to themselves, which saves most of the work."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def heavy_digests(digests: DataFrame, tracked: int = TRACKED, top: int = TOP) -> DataFrame:
    """(digest, first_id, group_size) of the verified winners; at most ``top`` rows."""
    items = digests.agg(F.expr(f"approx_top_k(digest, {top}, {tracked})").alias("items"))
    candidates = items.select(F.explode("items.item").alias("digest"))
    return (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED, top: int = TOP) -> DataFrame:
    """(id, digest, first_id, group_size), one row per input row."""
    digests = store(df.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")), "digests")
    heavy = store(heavy_digests(digests, tracked, top), "heavy")  # at most `top` rows
    split = digests.join(F.broadcast(heavy), "digest", "left")
    hot = split.where("group_size is not null").select("id", "digest", "first_id", "group_size")
    rest = split.where("group_size is null").select("id", "digest")
    sizes = rest.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("group_size"))
    return hot.unionByName(rest.join(sizes, "digest").select("id", "digest", "first_id", "group_size"))


@query("op5_exact_dedup", """
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
  doc_id is not distinct from min(doc_id) over (partition by text_sha256) as kept, text_sha256
from d""")
def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    groups = exact_groups(documents(spark, sf_dir))
    return groups.select(
        F.col("id").alias("doc_id"), F.col("first_id").alias("keep_id"), "group_size",
        F.col("id").eqNullSafe(F.col("first_id")).alias("kept"), F.col("digest").alias("text_sha256"))
