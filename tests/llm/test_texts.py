"""Piece encoding against the library, fill-in-the-middle against slices of strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from flowloom.llm import fill_middle, pieces
from flowloom.llm.catalog import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.load(PATH).build()


@pytest.fixture(params=["small", "edge"])
def corpus(request, sf_dir):
    if request.param == "small":
        return sf_dir, request.getfixturevalue("small")
    return request.getfixturevalue("edge_dir"), request.getfixturevalue("edge_rows")


def test_query_equals_the_library(spark, corpus, library):
    folder, docs = corpus
    wanted = []
    for i, text, *_ in docs:
        ids = library.encode(text or "", add_eos=True)
        wanted.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    got = [tuple(r) for r in QUERIES["op11_pieces"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_ids_and_texts_of_the_operator(spark, library):
    docs = spark.createDataFrame([(1, "a  b\n\tñ"), (2, None), (2, "")], "doc_id int, text string")
    rows = pieces.encode_documents(docs, PATH)
    assert dict(rows.dtypes)["id"] == "int"
    back = pieces.decode_documents(rows.drop("decoded").withColumn("decoded", F.lit("old")), PATH)
    for r in back.collect():
        assert r["n_tokens"] == len(r["ids"]) and r["decoded"] == library.decode(r["ids"]) == ("a  b\n\tñ" if r["id"] == 1 else "")
    assert pieces.encode_documents(docs.limit(0), PATH).count() == 0


def test_encoding_of_noise(own, library):
    rng = random.Random(1)
    parts = [" ", "  ", "▁", "a", "the", " the", "\n", "\t", "é", "😀", "\x00", "0", "12", "漢", "字", "ing", "er", "<s>", "<0x0A>", "�", "̈", " " * 15, " " * 17, "aaaa", "ABC", "​", "￿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(8000)]
    texts += [" " * k for k in range(70)] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x10000, 0x110000)])) for _ in range(20)) for _ in range(1000)]
    assert [own.encoded(t)[0] + [own.end_id] for t in texts] == library.encode(texts, add_eos=True)


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 100_000, " " * 300_001 + "the", "\n" * 50_000, "1" * 50_000, "the" * 60_000, "é漢" * 40_000])
def test_encoding_of_long_stretches(own, library, text):
    assert own.encoded(text)[0] == library.encode(text)


def test_neighbours_and_failed_positions(own):
    """The encoding is what merging the whole stretch yields; some stretches need a step back."""
    rng = random.Random(4)
    steps_back = 0
    for _ in range(2000):
        text = "".join(rng.choice("aehinorst▁") for _ in range(rng.randint(1, 14)))
        ids = own.stretch(text)
        assert [own.table[i][0] for i in ids] == own.merged(text)
        greedy, at = [], 0
        while at < len(text):
            piece = next(text[at:at + n] for n in range(16, 0, -1) if text[at:at + n] in own.ids)
            greedy.append(piece)
            at += len(piece)
        steps_back += greedy != own.merged(text)
    assert steps_back > 100


def test_pairs_are_judged_without_merging_them_anew():
    """Whether two pieces fit is what merging their joined text says, equal scores included; each piece is merged once, not each pair."""
    for seed in range(30):
        rng = random.Random(seed)
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(40)}
        table = [(c, -100.0, pieces.NORMAL) for c in "abc"] + [(w, float(-rng.randrange(8)), pieces.NORMAL) for w in sorted(words)]
        small = pieces.Pieces(table, 0).build()
        merged, calls = small.merged, []
        small.merged = lambda text, *rest: calls.append(text) or merged(text, *rest)  # noqa: B023
        found = {(a, b): small.fits(a, b) for a in small.ids.values() for b in small.ids.values()}
        assert len(calls) <= len(small.ids) and len(set(calls)) == len(calls)
        for (a, b), fits in found.items():
            x, y = table[a][0], table[b][0]
            assert fits == (merged(x + y) == [x, y]), (seed, x, y)


def test_decoding_of_any_ids(own, library):
    rng = random.Random(5)
    lists = [[rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    assert [own.decoded(ids) for ids in lists] == library.decode(lists)


def test_few_remembered_stretches(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    own = pieces.load(PATH).build()
    texts = ["one two three one two three four five six one", "two one two"] * 3
    assert [own.encoded(t)[0] for t in texts] == library.encode(texts)


def by_hand(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text))
    return (doc_id, n, "psm", a, b - a, sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text))


FORM_COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_fill_middle(spark, corpus):
    folder, docs = corpus
    got = [tuple(r) for r in QUERIES["op13_fill_middle"](spark, folder).select(*FORM_COLUMNS).collect()]
    assert sorted(got, key=str) == sorted((by_hand(i, t) for i, t, *_ in docs), key=str)


def test_fill_middle_of_marks_and_very_long_texts(spark, tmp_path, write_corpus):
    rng = random.Random(6)
    parts = ["<", "P", "S", "M", ">", "<P", "S>", "é", "漢", "😀", "x", "<<", ">>"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))), None, None, None) for i in range(600)]
    docs += [(1000 + i, "<P>"[: 1 + i % 3] * (i + 1), None, None, None) for i in range(30)] + [(2000 + i, "ab漢é" * 400_000, None, None, None) for i in range(3)]
    folder = write_corpus(tmp_path, docs)
    got = [tuple(r) for r in QUERIES["op13_fill_middle"](spark, folder).select(*FORM_COLUMNS).collect()]
    assert sorted(got, key=str) == sorted((by_hand(i, t) for i, t, *_ in docs), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_output_restores_from_itself_and_its_form(monkeypatch):
    """Windows and slices of any size give the same bytes, and the inverse sees only output and form."""
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("ab<>PSMé漢")) for _ in range(rng.integers(0, 40))) for _ in range(200)]
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in data])))
    draws = rng.integers(0, 1 << 32, (200, 4))
    seen = []
    for window in (1 << 20, 7):
        monkeypatch.setattr(fill_middle, "WINDOW", window)
        made = fill_middle.build(np.frombuffer(b"".join(data), np.uint8), offsets, draws)
        text, ends = fill_middle.restore(made["out"], made["offsets"], made["form"])
        assert text.tobytes() == b"".join(data) and (ends == offsets).all()
        seen.append(made["out"].tobytes())
    assert seen[0] == seen[1]


@pytest.mark.parametrize("name", ["op11_pieces", "op13_fill_middle"])
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0
