"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader.

Tokens are words and runs of punctuation, case kept; features are hashed unigrams and bigrams
(all repeats of a token share one bigram) with value sqrt(count / all), so a
text's vector has length one whatever its size. The learner (FTRL-proximal) sees at most ``TRAIN_ROWS`` labelled documents, those with
the smallest hash of their id, in that order, ``EPOCHS`` times, in one task: that bound is fixed, so the task doesn't
grow. Spark sorts and, where needed, spills the passes; the learner sees them as a stream and holds the model only. The model is a weight per bucket (2^20 at most) and is broadcast; scoring is a sparse dot product per document.

Defined results: null, empty and token-free texts have no features and get the bias alone as their score (still between 0 and
1); a document with several labels counts once, as the larger one; unlabelled rows and null labels aren't learned from; with
nothing to learn from every score is 0.5; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, id_bucket, slices

TRAIN_ROWS, EPOCHS, BITS = 12_000, 2, 20
ALPHA, BETA, L1, L2 = 0.5, 0.1, 0.02, 0.1
#: Score from which a document counts as good, and the held-out fold.
THRESHOLD, FOLDS, HELD_OUT = 0.3, 5, 0
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Token hashes that a worker keeps; what is met again soon is met among the last ones.
REMEMBERED = 1 << 16
#: The bigram of any token with itself, so that stuttering is learned for words never seen.
REPEAT = np.uint64(0xF00DF00DF00DF00D)


class Hashes(dict):
    """Token hashes, remembered up to a limit."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) >> 1
        return value


def features(texts: list[str | None], seen: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of a batch, sorted by row and bucket."""
    rows, buckets, totals = [], [], np.ones(len(texts))
    for i, text in enumerate(texts):
        tokens = TOKEN.findall(text or "")
        if not tokens:
            continue
        h = np.fromiter(map(seen.__getitem__, tokens), np.uint64, len(tokens))
        pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        pairs[h[:-1] == h[1:]] = REPEAT
        own = np.concatenate((h * np.uint64(0xD6E8FEB86659FD93), pairs)) >> np.uint64(64 - BITS)
        own, counts = np.unique(own, return_counts=True)
        rows.append(np.full(len(own), i))
        buckets.append(own.astype(np.int64))
        totals[i] = counts.sum()
        rows[-1] = (rows[-1], counts)
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    row = np.concatenate([r for r, _ in rows])
    count = np.concatenate([c for _, c in rows])
    return row, np.concatenate(buckets), np.sqrt(count / totals[row])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = Hashes()
    for batch in batches:
        for part in slices(batch, "text"):
            row, bucket, value = features(part.column("text").to_pylist(), seen)
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
            packed = [(bucket[a:b].astype(np.int32).tobytes(), value[a:b].astype(np.float32).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("turn"), part.column("label"), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())],
                names=["turn", "label", "bucket", "value"])


def train(examples: Iterable[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal over (label, buckets, values) in the order given: (weights, bias). One epoch reads an iterator once."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for label, at, x in examples:
            own_z, own_n = z[at], n[at]
            w = weights(own_z, own_n)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x + bias, -30, 30)))
            g = (p - label) * x
            z[at] += g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA * w
            n[at] += g * g
            g = p - label
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
    w = np.zeros(1 << BITS)
    for at in np.array_split(np.flatnonzero(z), 16):
        w[at] = weights(z[at], n[at])
    return w, float(bias)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for label, bucket, value in zip(batch.column("label").to_pylist(), batch.column("bucket"), batch.column("value"), strict=True):
            yield label, np.frombuffer(bucket.as_buffer(), np.int32), np.frombuffer(value.as_buffer(), np.float32)


def _train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of examples that come as often as they are to be seen."""
    w, bias = train(_examples(batches), epochs=1)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([w[at].astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], names=["bucket", "weight", "bias"])


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """At most ``most`` labelled documents outside the held-out fold: (turn, label, text)."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (id_bucket("doc_id", FOLDS) != HELD_OUT))
        .groupBy("doc_id").agg(F.max("quality").alias("label"))
        .select("doc_id", "label", F.xxhash64("doc_id").alias("turn")).orderBy("turn", "doc_id").limit(most)
    )
    # at most `most` rows of three numbers: a fixed bound
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("turn", F.col("label").cast("int").alias("label"), "text")
    return found


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    rows = labelled(docs, labels, most).mapInArrow(_featurise, "turn long, label int, bucket binary, value binary")
    passes = rows.repartition(1).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).sortWithinPartitions("epoch", "turn", "bucket", "value")
    model = passes.mapInArrow(_train_all, "bucket binary, weight binary, bias double").collect()
    weights = np.zeros(1 << BITS, np.float32)
    if not model:
        return weights, 0.0
    weights[np.frombuffer(model[0]["bucket"], np.int32)] = np.frombuffer(model[0]["weight"], np.float32)
    return weights, model[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 added; a column of that name is replaced."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        seen = Hashes()
        for batch in batches:
            for part in slices(batch, text_col):
                row, bucket, value = features(part.column(text_col).to_pylist(), seen)
                margin = np.bincount(row, weights[bucket] * value, minlength=part.num_rows) + bias
                scores = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*part.schema.names, out])
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs``; rows scored below the threshold go."""
    return score(docs, model, out="__score").where(F.col("__score") >= threshold).drop("__score")


@query("op2_quality")
def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, documents(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (id_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
