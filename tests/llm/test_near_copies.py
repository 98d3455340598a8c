"""The pipeline's near-duplicate stage against brute-force groups by Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from flowloom.llm import near_copies
from flowloom.llm.common import documents


def brute_force(rows):
    """doc_ids that stay: the smallest of each group of texts whose sets of five-word shingles are at least 4/5 alike."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").lower().encode().split()
        sets.append(frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return sorted(min((x for x in ids if x is not None), default=-1) for ids in groups.values())


def stays(spark, folder):
    return sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents(spark, folder), folder).collect())


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(25):  # families around the limit of 0.8
        base = [word() for _ in range(rng.choice([12, 60, 150, 400]))]
        texts += [" ".join(base), *(edited(rng, base, rng.randint(1, max(1, len(base) // 20))) for _ in range(4))]
    base = [word() for _ in range(80)]
    texts += [edited(rng, base, rng.randint(0, 2)) for _ in range(120)]  # one large group of near copies, in chains
    texts += [" ".join([*passage, *(word() for _ in range(rng.randint(5, 60)))]) for _ in range(60)]  # one common passage
    texts += [None, "", " \n", "One two", "one TWO", "Ä b c d e f", "ä b c d e f"]
    rng.shuffle(texts)
    return [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(None, texts[0], "en", "a", 1), (None, "alone " * 9, "en", "a", 1)]


def test_stage_against_brute_force(spark, write_corpus, tmp_path):
    rows = corpus()
    assert stays(spark, write_corpus(tmp_path, rows)) == brute_force(rows)


@pytest.mark.parametrize("few, block", [(64, 2000), (3, 7)])
def test_pairs_that_met_no_leader_are_still_held_against_each_other(spark, write_corpus, tmp_path, monkeypatch, few, block):
    """Without any round of leaders the groups are those of brute force, by the join and by blocks of a key."""
    for name, value in (("ROUNDS", 0), ("FEW", few), ("BLOCK", block)):
        monkeypatch.setattr(near_copies, name, value)
    rows = corpus()
    assert stays(spark, write_corpus(tmp_path, rows)) == brute_force(rows)


def test_links_are_exact_and_recall_is_measured(spark, write_corpus, tmp_path):
    """Of the brute-force pairs nearly all lie in one group, and no group joins texts that no chain of such pairs joins."""
    rows = corpus()
    sets = [near_copies.shingles(t) for _, t, *_ in rows]
    slim = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id long, text string")
    slim.write.parquet(f"{tmp_path}/d.parquet")
    texts = near_copies._texts(spark.read.parquet(f"{tmp_path}/d.parquet"))
    nodes = near_copies.store(texts.mapInArrow(near_copies._nodes, "id long, mark long, node long, size int, sketch binary, fp long, bands array<long>"), "n")
    firsts = nodes.dropDuplicates(["node"]).selectExpr("node", "struct(id is null as none, id, mark) as x", "size", "sketch", "fp")
    root = {r["node"]: r["root"] for r in near_copies.node_roots(nodes, near_copies.store(firsts, "f"), texts).collect()}
    node = {r["id"]: r["node"] for r in nodes.collect()}
    pairs = [(i, j) for i, j in combinations(range(len(rows)), 2)
             if len(sets[i]) and len(sets[j]) and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    together = [root.get(node[i], node[i]) == root.get(node[j], node[j]) for i, j in pairs]
    assert len(pairs) > 1000 and sum(together) / len(together) >= 0.99


def test_a_common_passage_makes_no_pairs_under_its_key(spark):
    """Members of a key are paired with two leaders only, whatever their number."""
    own = spark.range(5000).selectExpr("7L as key", "xxhash64(id) as node", "xxhash64(id) as root")
    assert near_copies.leader_pairs(own, 0).count() <= 2 * 5000


def alike(rng, n, changed):
    """Two sets of n hashes that differ in ``changed`` of them each."""
    pool = np.unique(np.array([rng.getrandbits(64) for _ in range(n + changed)], np.uint64))
    order = rng.sample(range(len(pool)), len(pool))
    return np.sort(pool[order[:n]]), np.sort(pool[order[changed:n + changed]])


@pytest.mark.parametrize("n", [16, 70, 130, 1000])
def test_sketches_rule_out_pairs_just_below_the_limit(n):
    """Sets at a similarity of about 0.74 do not stay open, those at the limit always do."""
    rng = random.Random(n)
    below = [alike(rng, n, round(0.15 * n) + 1) for _ in range(200)]
    assert sum(near_copies.may_link(near_copies.sketch(x), near_copies.sketch(y), 2 * n) for x, y in below) <= 10
    limit = [alike(rng, n, n // 9) for _ in range(50)]
    assert all(near_copies.may_link(near_copies.sketch(x), near_copies.sketch(y), 2 * n) for x, y in limit)


def test_a_short_text_in_a_block_leaves_the_other_sketches_whole():
    """In a block that holds texts of every size, the pairs that stay open are those that their own sketches leave open."""
    rng = random.Random(5)
    sets = [own for n in (3, 40, 500) for _ in range(30) for own in alike(rng, n, rng.choice([0, 1, n // 9, n // 5]))]
    sets += [own for n in (60, 127, 255) for _ in range(30) for own in (lambda x: (x, x[:len(x) - len(x) // 12]))(alike(rng, n + 8, 0)[0])]
    for i, j in ((0, 0), (0, 1)):
        block = [rng.choice([i, j]) for _ in sets]
        table = pa.table({"i": [i] * len(sets), "j": [j] * len(sets), "block": block, "node": range(len(sets)), "root": range(len(sets)), "size": [len(x) for x in sets],
                          "sketch": [near_copies.sketch(x) for x in sets]})
        may = {(a, b) for a, b in combinations(range(len(sets)), 2) if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b]))
               and (i == j or block[a] != block[b]) and near_copies.may_link(near_copies.sketch(sets[a]), near_copies.sketch(sets[b]), len(sets[a]) + len(sets[b]))}
        found = near_copies._open_in_blocks(table).to_pylist()
        assert sorted((r["a"], r["b"]) for r in found) == sorted(may) and len(may) > 50


def test_stage_on_the_test_tables(spark, edge_dir, edge_rows, sf_dir, small):
    assert stays(spark, edge_dir) == brute_force(edge_rows)
    assert stays(spark, sf_dir) == brute_force(small)
