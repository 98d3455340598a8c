"""The pipeline: stage by stage against brute force, and as registered."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from flowloom.llm import quality
from flowloom.llm.catalog import QUERIES
from flowloom.llm.common import documents
from test_near_copies import brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keys(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_stages_keep_what_they_should(spark, edge_dir):
    docs = documents(spark, edge_dir)
    columns = docs.columns
    before = docs.collect()
    # quality: exactly the rows at or above the threshold stay
    scores = quality.score(docs, quality.fit(docs, documents(spark, edge_dir, "labels"))).collect()
    good = corpus_pipeline.keep_good(spark, docs, edge_dir)
    assert good.columns == columns
    assert keys(good.collect()) == Counter((r["doc_id"], r["text"]) for r in scores if r["score"] >= 0.3)
    # near-duplicates: one row of each component, the one with the smallest id
    unique = corpus_pipeline.near_dedup(spark, docs, edge_dir)
    assert unique.columns == columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in unique.collect()) == brute_force([tuple(r) for r in docs.select(*COLUMNS).collect()])
    # decontamination: the rows that contain an item go
    found = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, edge_dir).collect()}
    clean = corpus_pipeline.decontaminated(spark, docs, edge_dir)
    assert clean.columns == columns and found
    assert keys(clean.collect()) == Counter((r["doc_id"], r["text"]) for r in before if r["doc_id"] not in found)
    # mixing: each row as often as the mix says
    taken = Counter()
    for r in QUERIES["op10_mixing"](spark, edge_dir).collect():
        taken[r["doc_id"]] += r["copies"]
    mixed = corpus_pipeline.mixed(spark, docs, edge_dir)
    assert mixed.columns == columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +taken
    # sharding: every row once, gapless slots
    placed = corpus_pipeline.sharded(spark, docs, edge_dir).collect()
    assert keys(placed) == keys(before)
    for s in range(8):
        slots = sorted(r["slot"] for r in placed if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_pipeline_runs_its_stages_in_order(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    got = QUERIES["pipeline"](spark, sf_dir)
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == COLUMNS
    order = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(map(tuple, docs.select(*order).collect()))


def test_pipeline_on_an_empty_table(spark, empty_dir):
    assert QUERIES["pipeline"](spark, empty_dir).count() == 0
