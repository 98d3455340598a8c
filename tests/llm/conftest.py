"""Small corpora for the operators: an ordinary one, one of edge cases, an empty one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from flowloom.llm.common import shared_folder

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
LABEL = "doc_id long, quality int, toxic int"
ITEM = "item_id long, text string"
#: Names that operators use inside, given to the edge-case table as columns of its own.
CLASHES = ["id", "mark", "fp", "size", "key", "class", "part", "rank", "copies", "shard", "slot", "score", "block", "name", "words", "n", "h", "w", "t", "x", "target", "label"]


def write(spark, folder, docs, labels=(), items=(), extra=()):
    frame = spark.createDataFrame(docs, DOC)
    for i, name in enumerate(extra):
        frame = frame.selectExpr("*", f"cast({i} as string) as `{name}`")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABEL).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), ITEM).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def edge_rows():
    rng = random.Random(5)
    common = [f"w{i}" for i in range(30)]
    passage = " ".join(rng.choice(common) for _ in range(25))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 3), (4, "one", "en", "b", 3),
        (5, "one two three", None, "b", 0), (6, passage, "en", "a", 1), (7, passage, "en", "a", 1), (8, passage + " tail", "de", None, 2),
        (8, passage + " tail", "de", None, 2), (9, "x " * 60, "fr", "c", 1), (10, "é ñ ß " * 30, "fr", "c", 1), (None, passage + " null id", "en", "a", 1),
        (11, "mail me at a.b@c.de. or +1 (168) 555-5254 from 10.0.0.1 card 4111 1111 1111 1111", "en", "d", 1),
        (12, "token = 'abcdefghijklmnop' AKIAABCDEFGHIJKLMN deadbeefdeadbeef é password: short", "en", "d", 1),
        (13, "A  B\tC", "en", "d", 1), (14, "A B C", "en", "d", 1), (15, "\x1c\x85 odd blanks", "en", "d", 1), (16, "Kſ \U0001f600 token=Kabcdefghijkl", "en", "d", 1),
    ]
    rows += [(100 + i, passage, "en", "hot", 1) for i in range(40)]  # a group of copies with a third of all rows
    rows += [(200 + i, " ".join(rng.choice(common) for _ in range(rng.randint(1, 80))), rng.choice(["en", "de", None]), rng.choice("abcdef"), 1) for i in range(40)]
    rows.append((300, " ".join(rng.choice(common) for _ in range(20000)), "en", "a", 1))  # very long
    return rows


@pytest.fixture(scope="session")
def edge_dir(spark, edge_rows, tmp_path_factory):
    items = [(1, edge_rows[5][1]), (2, "too short"), (3, None), (4, " ".join(edge_rows[5][1].split()[:12]))]
    labels = [(i, i % 2, 0) for i in range(200, 240)] + [(200, None, None), (None, 1, 0), (201, 1, 0)]
    return write(spark, tmp_path_factory.mktemp("edge"), edge_rows, labels, items, CLASHES)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.fixture(scope="session", autouse=True)
def scratch(spark):
    return shared_folder(spark)


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="session")
def write_corpus(spark):
    return lambda folder, docs: write(spark, folder, docs)
