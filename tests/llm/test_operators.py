"""Each operator's query against brute force, on ordinary rows, edge cases and an empty table."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from flowloom.llm import queries  # noqa: F401
from flowloom.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def rows_of(spark, name, folder):
    found = [r.asDict() for r in QUERIES[name](spark, folder).collect()]
    return sorted(found, key=lambda r: (LAST if r["doc_id"] is None else r["doc_id"], str(r)))


@pytest.fixture(params=["small", "edge"])
def corpus(request, sf_dir):
    if request.param == "small":
        return sf_dir, request.getfixturevalue("small")
    return request.getfixturevalue("edge_dir"), request.getfixturevalue("edge_rows")


def same(got, wanted, columns):
    key = lambda r: tuple("" if r[c] is None else str(r[c]) for c in columns)
    assert Counter(map(key, got)) == Counter(map(key, wanted))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def text_mark(text):
    """Spark's xxhash64 of a text; a null one leaves the seed."""
    value = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def without_repeats_by_hand(docs):
    """Documents of one id are told apart by the hash of their text."""
    seen: dict = {}
    for i, text, *_ in docs:
        words, mark = tuple(WORD.findall(text or "")), text_mark(text)
        for s in range(len(words) - 19):
            place = (LAST if i is None else i, mark, s)
            seen[words[s:s + 20]] = min(place, seen.get(words[s:s + 20], place))
    wanted = []
    for i, text, *_ in docs:
        words, mark = tuple(WORD.findall(text or "")), text_mark(text)
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            if seen[words[s:s + 20]] < (LAST if i is None else i, mark, s):
                gone[s:s + 20] = [True] * 20
        wanted.append({"doc_id": i, "n_words": len(words), "n_removed": sum(gone), "kept_sha256": sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))})
    return wanted


def test_substring_dedup_of_shared_stretches(spark, tmp_path, write_corpus):
    """Stretches shared without a repeated window, and rows without id that share an opening."""
    stretch, opening = " ".join(f"w{i}" for i in range(18)), " ".join(f"v{i}" for i in range(25))
    short = [(i, f"a{i} {stretch} b{i}", None, None, None) for i in range(20)]
    assert {r["n_removed"] for r in rows_of(spark, "op1_substring_dedup", write_corpus(tmp_path / "a", short))} == {0}
    docs = short + [(None, f"{opening} tail {i}", None, None, None) for i in range(3)] + [(7, f"{opening} other", None, None, None), (7, f"{opening} other", None, None, None), (7, f"x {opening}", None, None, None)]
    got = rows_of(spark, "op1_substring_dedup", write_corpus(tmp_path / "b", docs))
    same(got, without_repeats_by_hand(docs), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    assert sorted(r["n_removed"] for r in got if r["doc_id"] is None) == [25, 26, 26]  # the word "tail" is shared as well


def test_substring_dedup(spark, corpus):
    folder, docs = corpus
    same(rows_of(spark, "op1_substring_dedup", folder), without_repeats_by_hand(docs), ["doc_id", "n_words", "n_removed", "kept_sha256"])


def test_substring_dedup_hot_names(spark, edge_dir, edge_rows, monkeypatch):
    from flowloom.llm import substring_dedup
    plain = rows_of(spark, "op1_substring_dedup", edge_dir)
    monkeypatch.setattr(substring_dedup, "HOT", 0)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    again = [r.asDict() for r in substring_dedup.without_repeats(docs).withColumnRenamed("id", "doc_id").collect()]
    same(again, plain, ["doc_id", "n_words", "n_removed", "kept_sha256"])
    assert all(sha(r["kept"]) == r["kept_sha256"] for r in again)


def test_fm_index_counts_windows():
    from flowloom.llm.fmindex import FmIndex
    rng = np.random.default_rng(3)
    stretches = [rng.integers(1, 4, rng.integers(5, 30)) for _ in range(40)]
    text = np.concatenate([np.append(s, 0) for s in stretches])
    lengths = np.array([len(s) for s in stretches])
    at, row = FmIndex(text, 5).matching(np.concatenate(([0], np.cumsum(lengths + 1)))[:-1], lengths)
    by_row = defaultdict(set)
    for a, r in zip(at.tolist(), row.tolist(), strict=True):
        by_row[r].add(tuple(text[a:a + 5].tolist()))
    assert len(at) == sum(n - 4 for n in lengths)
    assert all(len(x) == 1 for x in by_row.values())
    assert len(by_row) == len({w for x in by_row.values() for w in x})


def test_exact_dedup(spark, corpus):
    folder, docs = corpus
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in docs]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    wanted = []
    for i, t in norm:
        first = min((x for x in groups[t] if x is not None), default=None)
        wanted.append({"doc_id": i, "keep_id": first, "group_size": len(groups[t]), "kept": i == first, "text_sha256": sha(t)})
    same(rows_of(spark, "op5_exact_dedup", folder), wanted, ["doc_id", "keep_id", "group_size", "kept", "text_sha256"])


def test_exact_dedup_splits_off_heavy_digests(spark, edge_dir):
    from flowloom.llm import exact_dedup as op
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    digests = docs.select(docs.doc_id.alias("id"), op.text_digest(docs.text).alias("digest"))
    heavy = op.heavy_digests(digests, tracked=16, top=4).collect()
    assert len(heavy) <= 4 and max(r["group_size"] for r in heavy) == 42  # 40 copies and two more rows


def test_quality(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = rows_of(spark, "op2_quality", "/root/testdata/sf0.01")
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    unseen = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert sum(p == q for p, q in unseen) / len(unseen) > 0.9
    assert all(p == 1 for p, q in unseen if q == 1)


def test_quality_edges(spark, edge_dir, edge_rows, empty_dir):
    got = rows_of(spark, "op2_quality", edge_dir)
    assert len(got) == len(edge_rows)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r["score"])
    assert by_id[1] == by_id[2] == by_id[3] and len(set(by_id[8])) == 1
    assert rows_of(spark, "op2_quality", empty_dir) == []


def test_quality_learns_as_a_plain_learner_does():
    from flowloom.llm import quality as op
    examples = [(i % 2, np.array([1 + i % 2, 7 + i % 5]), np.array([0.7, 0.7])) for i in range(200)]
    w, bias = op.train(examples)
    z, n, zb, nb = defaultdict(float), defaultdict(float), 0.0, 0.0
    weight = lambda j: 0.0 if abs(z[j]) <= op.L1 else -(z[j] - np.sign(z[j]) * op.L1) / ((op.BETA + n[j] ** 0.5) / op.ALPHA + op.L2)
    for _ in range(op.EPOCHS):
        for label, at, x in examples:
            b = -zb / ((op.BETA + nb ** 0.5) / op.ALPHA)
            ws = [weight(j) for j in at.tolist()]
            g0 = 1 / (1 + np.exp(-(sum(a * c for a, c in zip(ws, x, strict=True)) + b))) - label
            for j, v, a in zip(at.tolist(), x, ws, strict=True):
                g = g0 * v
                z[j] += g - ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / op.ALPHA * a
                n[j] += g * g
            zb += g0 - ((nb + g0 * g0) ** 0.5 - nb ** 0.5) / op.ALPHA * b
            nb += g0 * g0
    assert np.allclose([w[j] for j in sorted(z)], [weight(j) for j in sorted(z)])
    assert bias == pytest.approx(-zb / ((op.BETA + nb ** 0.5) / op.ALPHA))


def test_decontamination(spark, corpus):
    folder, docs = corpus
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]

    def shingles(text):
        w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    own = [(i, shingles(t)) for i, t in items]
    best = {}
    for i, t, *_ in docs:
        mine = shingles(t)
        for item, s in own:
            if s and len(mine & s) * 100 >= len(s) * 80:
                best[i, item] = max(best.get((i, item), 0), len(mine & s))
    got = {(r["doc_id"], r["item_id"]): r["shared"] for r in rows_of(spark, "op3_decontamination", folder)}
    assert got == best and best


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
SECRETS = (("assign", ASSIGN, lambda m: len(m[2]) >= 12), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16))


def luhn(number):
    values = [int(c) for c in reversed(number)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def only_digits(m):
    return re.sub("[^0-9]", "", m[0])


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(only_digits(m)) <= 15),
)


def base_spans(rules, text):
    return sorted((m.start(), k, m.end()) for k, (_, p, keep) in enumerate(rules) for m in p.finditer(text or "") if keep(m))


def listed(rules, spans):
    return ",".join(f"{rules[k][0]}:{a}:{b}" for a, k, b in spans)


def holds_spans(got, docs, rules):
    wanted = []
    for i, t, *_ in docs:
        spans = base_spans(rules, t)
        wanted.append({"doc_id": i, "base_sha256": sha(listed(rules, spans)), **{f"n_{name}": sum(x[1] == k for x in spans) for k, (name, *_) in enumerate(rules)}})
    same(got, wanted, ["doc_id", "base_sha256", *[f"n_{r[0]}" for r in rules]])
    text = {i: t for i, t, *_ in docs}
    for r in got:
        all_spans = r["spans"].split(",") if r["spans"] else []
        base = listed(rules, base_spans(rules, text[r["doc_id"]]))
        assert set(base.split(",") if base else []) <= set(all_spans)
        starts = [int(x.split(":")[1]) for x in all_spans]
        assert starts == sorted(starts)


def test_secrets(spark, corpus):
    holds_spans(rows_of(spark, "op4_secrets", corpus[0]), corpus[1], SECRETS)


def test_personal_data(spark, corpus):
    holds_spans(rows_of(spark, "op6_pii", corpus[0]), corpus[1], PERSONAL)


@pytest.fixture(scope="module")
def noise():
    import random
    rng = random.Random(11)
    secret = ["password", "SECRET", "Token", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "0123456789abcdef", "deadbeef", "é", "x", "ABCDEFGH12345", "-", ".", "=="]
    personal = ["a", "b.c", "@", ".", "..", "-", "+", "1", "12", "255", "256", "4111111111111111", "4111 1111", " ", "1111-1111", "(", ")", "_", "%", "é", "+1 5", "55-1234", "a@b.co", "1.2.3.4"]
    return [(i, "".join(rng.choice(toks) for _ in range(rng.randint(0, 16))), None, None, None) for i, toks in enumerate([secret, personal] * 1500)]


def test_spans_of_noise(spark, noise, tmp_path, write_corpus):
    folder = write_corpus(tmp_path / "noise", noise)
    holds_spans(rows_of(spark, "op4_secrets", folder), noise, SECRETS)
    holds_spans(rows_of(spark, "op6_pii", folder), noise, PERSONAL)


def test_secret_rules_beyond_the_base():
    from flowloom.llm.secrets import Scanner, automaton
    text = "é -----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " xoxb-123456789012-abcdefghijk eyJhbGci.eyJzdWIi.c2ln"
    found = [(Scanner(automaton()).rules[k].kind, text[a:b][:5]) for a, k, b in Scanner(automaton()).scan(text)]
    assert found == [("pem", "-----"), ("git", "ghp_a"), ("chat", "xoxb-"), ("jwt", "eyJhb")]


def test_rules_that_are_not_prompt_are_refused():
    from flowloom.llm.automaton import compile_rules
    with pytest.raises(ValueError):
        compile_rules(["a(bbc)?"])


def test_reliabilities_find_the_bad_labeler():
    from flowloom.llm.pii import reliabilities
    patterns = [("k", (1, 1, 0, -1, -1), 400), ("k", (0, 0, 1, -1, -1), 300), ("k", (1, 1, 1, -1, -1), 100), ("k", (0, 0, 0, -1, -1), 100)]
    prior, dist = reliabilities(patterns)
    assert dist[0, 1][2] > 0.9 and dist[1, 0][1] > 0.9 and dist[2, 1][2] < 0.5 and 0.3 < prior["k"] < 0.7


def test_language(spark, sf_dir):
    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = rows_of(spark, "op7_langid", folder)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    unseen = [r["lang_pred"] == langs[r["doc_id"]] for r in got if r["held_out"]]
    assert len(got) == 1000 and sum(unseen) / len(unseen) > 0.97


def test_language_edges(spark, edge_dir, edge_rows, empty_dir):
    got = rows_of(spark, "op7_langid", edge_dir)
    assert len(got) == len(edge_rows)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == "und" and {*by_id.values()} <= {"und", "en", "de", "fr"}
    assert rows_of(spark, "op7_langid", empty_dir) == []


def fingerprints_by_hand(docs):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    out = []
    for i, t, *_ in docs:
        w = WORD.findall((t or "").translate(lower))
        pieces = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
        out.append((i, sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))))
    return out


def test_simhash(spark, corpus):
    folder, docs = corpus
    fps = fingerprints_by_hand(docs)
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 4:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(fps):
        least[root(k)] = min(LAST if i is None else i, least.get(root(k), LAST))
    wanted = [{"doc_id": i, "fingerprint": f"{fp:016x}", "component_id": least[root(k)]} for k, (i, fp) in enumerate(fps)]
    same(rows_of(spark, "op8_simhash", folder), wanted, ["doc_id", "fingerprint", "component_id"])


def groups_of(members, heads, tails):
    up = {x: x for x in members}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
        up[root(a)] = root(b)
    out = defaultdict(set)
    for x in members:
        out[root(x)].add(x)
    return {frozenset(g) for g in out.values()}


def test_simhash_bucket_search_and_midpoints_agree():
    from flowloom.llm.simhash import _midpoints, bucket_edges
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 60, 3)).astype(np.uint64)
    members = np.unique(np.concatenate([c ^ np.bitwise_xor.reduce(f[:, : 1 + k], axis=1) for k, (c, f) in enumerate(zip(centre, flips, strict=True))]))
    a, b = groups_of(members.tolist(), *bucket_edges(members)), groups_of(members.tolist(), *_midpoints(members))
    assert a == b and len(a) < len(members)


def test_simhash_masks_cover_every_close_pair():
    from flowloom.llm.simhash import probe_masks
    rng = np.random.default_rng(4)
    sample = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    assert len(probe_masks(sample[:0], 0)) <= 64
    for n in (1, 100, 10 ** 6, 10 ** 10):
        masks = probe_masks(sample, n)
        for _ in range(300):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flips & m == 0 for m in masks)


def test_sharding(spark, corpus):
    folder, docs = corpus
    got = rows_of(spark, "op9_sharding", folder)
    wanted = [{"doc_id": i, "size": len((t or "").encode()) + 1, "text_crc32": zlib.crc32((t or "").encode())} for i, t, *_ in docs]
    same(got, wanted, ["doc_id", "size", "text_crc32"])
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(8):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 8) <= largest
    again = rows_of(spark, "op9_sharding", folder)
    same(again, got, ["doc_id", "size", "shard", "slot"])


def targets_by_hand(docs):
    size = defaultdict(int)
    for _, t, _, source, _ in docs:
        size[source] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, target = sum(size.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= 3 * size[s]
            free.discard(s)
    return size, target


def test_mixing(spark, corpus):
    folder, docs = corpus
    size, target = targets_by_hand(docs)
    got = rows_of(spark, "op10_mixing", folder)
    assert len(got) == len(docs)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    longest = {s: max(r["size"] for r in got if r["source"] == s) for s in size}
    for s in size:
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 0.6 * longest[s]), s
    same(rows_of(spark, "op10_mixing", folder), got, ["doc_id", "taken", "target"])


def test_mixing_rates_solve_the_dual(spark, sf_dir):
    from flowloom.llm import mixing as op
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select(*op.slim_columns(docs))
    targets = op.source_targets(slim)
    cells = op.in_cells(slim, op.hot_cells(slim, 200)).groupBy("source", "class", "part").agg({"size": "sum", "doc_id": "count"}).toDF("source", "class", "part", "words", "n")
    lam = {r["source"]: r["lam"] for r in op.multipliers(cells, targets).collect()}
    rows = cells.collect()
    for t in targets.collect():
        mean = t["source_size"] / t["n"]
        given = sum(c["words"] * min(3.0, np.exp(min(50, lam[t["source"]] * c["words"] / c["n"] / mean))) for c in rows if c["source"] == t["source"])
        assert given == pytest.approx(t["target"], rel=1e-3)


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_decontamination", "op4_secrets", "op5_exact_dedup", "op6_pii", "op8_simhash", "op9_sharding", "op10_mixing"])
def test_empty_table(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0
