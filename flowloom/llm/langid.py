"""Language identification with language-bitmask n-gram filters.

A language's set holds the letter n-grams (3 and 4 letters, word boundaries included) found in at least ``LEAST_SHARE`` of its sampled
training documents. All sets live in one bit-sliced Bloom filter: slot x holds a bitmask with one bit per language (as many 64-bit words as
the languages need), and the AND of an n-gram's ``PROBES`` slots is the set of all languages that contain it. Per document, each language's hits among the N n-grams are counted and
corrected for its false-positive rate f = fill^PROBES:  (hits - N f) / (1 - f). The largest corrected count decides; the score is its share
of all corrected counts.

Sampling: at most about ``PER_LANG`` whole documents a language, chosen by a hash of the id (the fraction is PER_LANG over
the language's count). Slots are a fixed number, so the filter that is collected and broadcast grows with the languages only, by
8 MB for each 64. Of fewer than ``FEW`` training documents every n-gram counts.

Defined results: null, empty and letter-free texts are ``und`` with score 0; with letters but no hit at all, the language with most training
documents is returned, score 0; rows with null lang aren't learned from; with nothing to learn from all is ``und``; ties go to the language
with more training documents, then the smaller name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, id_bucket, store, unit_hash

PER_LANG, LEAST_SHARE = 2000, 0.01
ORDERS, SLOT_BITS, PROBES = (3, 4), 20, 3
FOLDS, HELD_OUT, UNKNOWN, FEW = 4, 2, "und", 10
WORD_BITS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter; made once per process or task."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str | None) -> np.ndarray:
    """64-bit hashes of the letter n-grams of a whole text, repeats included; each word has a blank on either side."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    own = letters()[points]
    if not own.any():
        return np.zeros(0, np.uint64)
    points = np.where(own, points, 32)
    points = points[np.concatenate(([True], own[1:] | own[:-1]))].astype(np.uint64)  # runs of blanks become one
    found = []
    for n in ORDERS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint64)
        inside = np.ones(len(h), bool)
        for i in range(n):
            part = points[i:len(points) - n + 1 + i]
            h = (h ^ part) * MIX
            h ^= h >> np.uint64(29)
            if 0 < i < n - 1:
                inside &= part != 32
        found.append(h[inside])
    return np.concatenate(found)


def slots(h: np.ndarray) -> list[np.ndarray]:
    step = h * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
    return [((h + np.uint64(i) * step) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for i in range(PROBES)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of n-grams per language and batch."""
    for batch in batches:
        by: dict[int, list[np.ndarray]] = {}
        for code, text in zip(batch.column("code").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by.setdefault(code, []).append(np.unique(grams(text)))
        for code, arrays in by.items():
            gram, n = np.unique(np.concatenate(arrays), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), code, np.int32)), pa.array(gram.view(np.int64)), pa.array(n)], names=["code", "gram", "n"])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code = batch.column("code").to_numpy()
        for slot in slots(batch.column("gram").to_numpy().view(np.uint64)):
            mask = np.left_shift(np.int64(1), (code % WORD_BITS).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(code // WORD_BITS), pa.array(mask)], names=["slot", "word", "mask"])


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray]:
    """(languages, slot masks by word) learned from rows outside the held-out fold."""
    spark = docs.sparkSession
    rows = docs.where(F.col("lang").isNotNull() & (id_bucket("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row a language
    table = np.zeros((max(1, -(-len(sizes) // WORD_BITS)), 1 << SLOT_BITS), np.uint64)
    if not sizes:
        return [], table
    shares = F.broadcast(spark.createDataFrame([(r["lang"], i, min(1.0, per_lang / r["count"])) for i, r in enumerate(sizes)], "lang string, code int, share double"))
    sample = rows.join(shares, "lang").where(unit_hash(F.col("doc_id"), F.lit("lang")) < F.col("share")).select("code", "text")
    counted = store(sample.mapInArrow(_counts, "code int, gram long, n long").groupBy("code", "gram").agg(F.sum("n").alias("n")), "grams")
    least = [(i, 1 if r["count"] < FEW else max(2, round(LEAST_SHARE * min(per_lang, r["count"])))) for i, r in enumerate(sizes)]
    kept = counted.join(F.broadcast(spark.createDataFrame(least, "code int, least long")), "code").where("n >= least").select("code", "gram")
    masks = kept.mapInArrow(_slots, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table[masks.column("word").to_numpy(), masks.column("slot").to_numpy()] = masks.column("mask").to_numpy().view(np.uint64)  # at most 2^SLOT_BITS rows a word
    return [r["lang"] for r in sizes], table


def decide(h: np.ndarray, langs: list[str], table: np.ndarray, false_rate: np.ndarray) -> tuple[str, float]:
    if not len(h) or not langs:
        return UNKNOWN, 0.0
    first, *others = slots(h)
    found = table[:, first]
    for slot in others:
        found = found & table[:, slot]
    hits = np.array([np.count_nonzero(found[i // WORD_BITS] >> np.uint64(i % WORD_BITS) & np.uint64(1)) for i in range(len(langs))])
    right = np.maximum(0.0, (hits - len(h) * false_rate) / (1 - false_rate))
    best = int(np.argmax(right))
    return langs[best], float(right[best] / right.sum()) if right.sum() > 0 else 0.0


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    langs, table = model
    fill = np.array([np.count_nonzero(table[i // WORD_BITS] >> np.uint64(i % WORD_BITS) & np.uint64(1)) / table.shape[1] for i in range(len(langs))])
    shared = docs.sparkSession.sparkContext.broadcast((langs, table, np.minimum(fill ** PROBES, 0.99)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [decide(grams(t.as_py()), *known) for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


@query("op7_langid")
def op7_langid(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", (id_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
