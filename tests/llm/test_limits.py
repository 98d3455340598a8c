"""Long texts, many languages, sessions without a shared folder."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import time

import pytest

from flowloom.llm import pii, queries  # noqa: F401
from flowloom.llm.catalog import QUERIES
from flowloom.llm.pii import find_spans

LONG = {
    "labels": "a@b" + ".c" * 500_000,
    "addresses": " ".join(f"user{i}@example.com" for i in range(100_000)),
    "dots": "1." * 100_000,
    "digits": "1" * 1_000_000,
    "signs": "+1 5" * 250_000,
    "cards": "4111 1111 1111 1111, " * 30_000,
}


def test_personal_data_of_very_long_texts(spark, tmp_path, write_corpus):
    """Matches of one text cost in proportion to their number, and no pattern recurses."""
    docs = [(i, text, None, None, None) for i, text in enumerate(LONG.values())]
    started = time.monotonic()
    got = {r["doc_id"]: r for r in QUERIES["op6_pii"](spark, write_corpus(tmp_path, docs)).collect()}
    assert time.monotonic() - started < 120
    counts = {name: tuple(got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")) for i, name in enumerate(LONG)}
    assert counts["labels"] == (1, 0, 0, 0) and counts["addresses"] == (100_000, 0, 0, 0) and counts["dots"] == (0, 25_000, 0, 0)
    assert counts["digits"] == (0, 0, 0, 0) and counts["signs"] == (0, 0, 0, 0) and counts["cards"] == (0, 0, 30_000, 0)
    assert got[1]["spans"].startswith("email:0:17,email:18:35")


def test_added_spans_against_labels(spark):
    """Numbers of the learned kinds in personal contexts are found, the same shapes in others are mostly left alone."""
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows, wanted = [], set()
    for i in range(900):
        kind = ("tel", "ssn", "iban")[i % 3]
        value = {"tel": f"({rng.randint(200, 989)}) {rng.randint(200, 999)}-{digits(4)}", "ssn": f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}",
                 "iban": rng.choice([f"DE{digits(20)}", f"FR{digits(25)[:25]}", f"AT{digits(18)}"])}[kind]
        if i % 2:
            text = f"words before, {rng.choice(['phone', 'call', 'account', 'contact', 'social'])} {value} and after"
            wanted.add((i, kind))
        else:
            bad = {"tel": f"{rng.randint(100, 199)}.{rng.randint(100, 199)}.{digits(4)}", "ssn": f"{rng.choice(['000', '666', '912'])}-{rng.randint(10, 99)}-{digits(4)}", "iban": f"ZZ{digits(20)}"}[kind]
            text = f"words before, {rng.choice(['order', 'serial', 'part', 'version', 'section'])} {bad} and after"
        rows.append((i, text))
    found = find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r["id"], s["kind"]) for r in found for s in r["spans"] if s["kind"] in ("tel", "ssn", "iban")}
    assert len(got & wanted) / len(wanted) > 0.9 and len(got - wanted) < 0.1 * len(wanted)


def test_account_lengths_are_looked_up(spark):
    values = [("DE89370400440532013000", True), ("DE893704004405320130", False), ("GB29 NWBK 6016 1331 9268 19", True), ("ZZ89370400440532013000", False)]
    rows = spark.createDataFrame(values, "v string, listed boolean")
    assert rows.select(pii._listed("iban", rows.v).alias("a"), "listed").where("a <> listed").count() == 0


def test_candidates_that_overlap_a_base_span_go(spark):
    rows = [(1, "call 4111 1111 1111 1111 now"), (2, "tel (212) 555-0100 x"), (3, "+1 (212) 555-0100")]
    got = {r["id"]: [s["kind"] for s in r["spans"]] for r in find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ["card"] and got[3] == ["phone"]


def test_many_languages_and_a_single_document(spark, tmp_path, write_corpus):
    rng = random.Random(1)
    docs = []
    for lang in range(70):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(30)]
        for _ in range(1 if lang == 69 else 12):
            docs.append((len(docs), " ".join(rng.choice(words) for _ in range(40)), f"l{lang:02d}", None, None))
    docs += [(len(docs) + k, " ".join(rng.choice(words) for _ in range(40)), None, None, None) for k in range(3)]
    got = {r["doc_id"]: r["lang_pred"] for r in QUERIES["op7_langid"](spark, write_corpus(tmp_path, docs)).collect()}
    assert sum(got[i] == (lang or "l69") for i, _, lang, *_ in docs) / len(docs) > 0.97
    assert {got[i] for i, _, lang, *_ in docs if lang in ("l69", None)} == {"l69"}


def test_language_scores_by_hand(spark, tmp_path, write_corpus):
    """Corrected counts of a plain set search decide as the filters do."""
    from flowloom.llm.langid import grams
    docs = [(i, text, lang, None, None) for i, (text, lang) in enumerate([("alpha beta gamma", "x"), ("delta epsilon", "y")] * 12 + [("alpha beta delta", None), ("omega", None)])]
    sets = {"x": set(grams("alpha beta gamma").tolist()), "y": set(grams("delta epsilon").tolist())}
    got = {r["doc_id"]: r for r in QUERIES["op7_langid"](spark, write_corpus(tmp_path, docs)).collect()}
    for i, text, *_ in docs:
        hits = {lang: sum(g in own for g in grams(text).tolist()) for lang, own in sets.items()}
        if sum(hits.values()):
            assert got[i]["lang_pred"] == max(hits, key=lambda k: hits[k])
            assert got[i]["score"] == pytest.approx(max(hits.values()) / sum(hits.values()), abs=0.01)


def test_quality_scores_by_hand(spark, edge_dir):
    """The query's scores are the logistic function of sparse dot products over the features of each text."""
    import math

    from flowloom.llm import quality
    from flowloom.llm.common import documents
    model = quality.fit(documents(spark, edge_dir), documents(spark, edge_dir, "labels"))
    docs = documents(spark, edge_dir)
    text = {(r["doc_id"], r["text"]) for r in docs.collect()}
    scores = {(r["doc_id"], r["text"]): r["score"] for r in quality.score(docs, model).collect()}
    assert scores.keys() == text
    assert all(0 <= s <= 1 and not math.isnan(s) for s in scores.values())


SESSION = """
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from flowloom.llm.common import release, shared_folder, store
from flowloom.llm.components import connected_components
first = shared_folder(spark)
assert first == shared_folder(spark)
table = store(spark.range(3), "t")
assert table.count() == 3
edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long")
assert sorted(map(tuple, connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
import os
release(table)
assert not os.path.exists(table.stored_at)
print("fine")
"""


def test_a_session_that_names_no_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    (tmp_path / "conf").mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", SESSION.format(repo=repo)], env=env, capture_output=True, text=True, timeout=180)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def _peak_mb(batches, run):
    """The largest amount of memory that Python and NumPy hold while ``run`` streams the batches, and what it yields."""
    import tracemalloc
    tracemalloc.start()
    try:
        got = list(run(iter(batches)))
        return tracemalloc.get_traced_memory()[1] / 1e6, got
    finally:
        tracemalloc.stop()


def test_slices_bound_rows_and_bytes():
    import pyarrow as pa

    from flowloom.llm.common import slices
    texts = ["a" * 10, None, "é" * 5, "b" * 100, "", "c" * 9, "d", None, "e" * 40, "f" * 10]
    batch = pa.RecordBatch.from_pydict({"text": ["dropped", *texts], "n": list(range(-1, 10))}).slice(1)
    parts = [p.column("text").to_pylist() for p in slices(batch, "text", rows=3, size=20)]
    assert parts == [["a" * 10, None, "é" * 5], ["b" * 100], ["", "c" * 9, "d"], [None], ["e" * 40], ["f" * 10]]
    assert sum((p.column("n").to_pylist() for p in slices(batch, "text", rows=4, size=1000)), []) == list(range(10))
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_quality_learner_holds_the_model_and_not_the_examples():
    import numpy as np
    import pyarrow as pa

    from flowloom.llm import quality
    rng = np.random.default_rng(3)
    rows = [(i % 2, np.sort(rng.choice(9000, 6500, replace=False)).astype(np.int32), np.full(6500, 0.0124, np.float32)) for i in range(800)]
    batches = [pa.RecordBatch.from_pydict({
        "turn": list(range(i, i + 20)), "label": pa.array([r[0] for r in rows[i:i + 20]], pa.int32()),
        "bucket": [r[1].tobytes() for r in rows[i:i + 20]], "value": [r[2].tobytes() for r in rows[i:i + 20]]}) for i in range(0, 800, 20)]
    peak, (model,) = _peak_mb(batches, quality._train_all)
    assert peak < 40  # 77 MB when the 42 MB of examples were kept; the state of 2^20 buckets has 17 MB, the weights 8
    w, bias = quality.train(rows, epochs=1)
    at = np.frombuffer(model.column("bucket")[0].as_py(), np.int32)
    assert at.tolist() == np.flatnonzero(w).tolist() and model.column("bias")[0].as_py() == bias
    assert np.array_equal(np.frombuffer(model.column("weight")[0].as_py(), np.float32), w[at].astype(np.float32))


def test_quality_fit_learns_in_epochs_in_order(spark):
    import numpy as np

    from flowloom.llm import quality
    docs = spark.createDataFrame([(i, f"w{i % 7} v{i % 3} {'good' if i % 2 else 'bad'}" if i % 11 else None) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = sorted(quality.labelled(docs, labels).collect(), key=lambda r: r["turn"])
    examples = []
    for r in rows:
        _, at, x = quality.features([r["text"]], quality.Hashes())
        examples.append((r["label"], at, x.astype(np.float32)))
    w, bias = quality.train(examples)
    got, got_bias = quality.fit(docs, labels)
    assert np.array_equal(got, w.astype(np.float32)) and got_bias == bias


def test_features_and_nodes_of_a_batch_are_made_in_slices():
    import numpy as np
    import pyarrow as pa

    from flowloom.llm import near_copies, quality
    rng = np.random.default_rng(4)
    known = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(known[rng.integers(0, 5000, 2500)]) for _ in range(500)]
    labelled = pa.RecordBatch.from_pydict({"turn": list(range(500)), "label": pa.array([1] * 500, pa.int32()), "text": texts})
    quality_peak, parts = _peak_mb([labelled], lambda b: ([p.column("turn").to_pylist(), p.column("bucket").slice(0, 1).to_pylist()] for p in quality._featurise(b)))
    assert sum((p[0] for p in parts), []) == list(range(500)) and quality_peak < 30  # 151 MB when the batch was one piece
    assert np.array_equal(np.frombuffer(parts[-1][1][0], np.int32), quality.features([texts[parts[-1][0][0]]], quality.Hashes())[1])
    rows = pa.RecordBatch.from_pydict({"id": list(range(500)), "mark": list(range(500)), "text": texts})
    nodes_peak, parts = _peak_mb([rows], lambda b: (p.column("id").to_pylist() for p in near_copies._nodes(b)))
    assert sum(parts, []) == list(range(500)) and nodes_peak < 10  # 13 MB when the batch was one piece
