"""Secret scan: all rules in one pass over the bytes of a text.

The rules' regular expressions are compiled by subset construction into one automaton (``automaton.py``), minimised, and laid out as
transition arrays. A scan reads each byte once, whatever the number of rules; the automaton tells where a match of a rule ends. The start of
the rare match is found by running the reversed rule backwards from there. Short matches are dropped by the rule's own test.

Rules in ``BASE`` are reported apart; ``MORE`` adds further credentials. Positions are code points, ends exclusive.

Defined results: a null text is empty and has no spans; invalid or non-ASCII characters never match; repeated rows are scanned alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.automaton import Automaton, Backwards, compile_rules
from flowloom.llm.catalog import query
from flowloom.llm.common import documents


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[str], bool]


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


KEYS = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
ASSIGN = rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)"""
_ASSIGN = re.compile(ASSIGN)
BASE = (
    Rule("assign", ASSIGN, lambda m: len(_ASSIGN.fullmatch(m)[2]) >= 12),
    Rule("access", "AKIA[A-Z0-9]+", lambda m: len(m) >= 18),
    # a run of 16 or more is a maximal run that is long enough, so no test is left
    Rule("hex", "[0-9a-f]{16}[0-9a-f]*", lambda m: True),
)
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", lambda m: True),
    Rule("git", "gh[opsu]_[A-Za-z0-9]+", lambda m: len(m) >= 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9\\-]+", lambda m: len(m) >= 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", lambda m: True),
)
RULES = BASE + MORE


@lru_cache(4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return compile_rules([r.pattern for r in rules])


class Scanner:
    """The transition arrays as linked rows: row[byte] is the next row, so a step is one look-up."""

    def __init__(self, found: Automaton, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        rows: list[list] = [[None] * 258 for _ in found.nexts]
        for row, targets, accepts, stops in zip(rows, found.nexts.tolist(), found.accepts.tolist(), found.stops.tolist(), strict=True):
            row[:256] = [rows[t] for t in targets]
            row[256] = accepts
            row[257] = stops
        self.first = rows[0]
        self.back = [Backwards(r.pattern) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(rule, end in bytes) of every match, in order of end."""
        row, out, i = self.first, [], 0
        for i, byte in enumerate(data):
            if row[256] and (stops := row[257][byte]):
                out += [(k, i) for k in range(len(self.rules)) if stops >> k & 1]
            row = row[byte]
        out += [(k, len(data)) for k in range(len(self.rules)) if row[256] >> k & 1]
        return out

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, ordered."""
        data = (text or "").encode("utf-8", "surrogatepass")
        last = [0] * len(self.rules)
        spans, at_byte, at_point = [], 0, 0
        for k, end in self.ends(data):
            start = self.back[k].start(data, end, last[k])
            last[k] = end
            if self.rules[k].keep(data[start:end].decode("ascii")):
                spans.append((start, k, end))
        spans.sort()
        out = []
        for start, k, end in spans:
            at_point += len(data[at_byte:start].decode("utf-8", "surrogatepass"))
            at_byte = start
            out.append((at_point, k, at_point + end - start))  # matches are ASCII
        return out


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, spans array<struct<kind, start, end, base>>), one row per document."""
    built = automaton(rules)
    base = {r.kind for r in BASE}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(built, rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            spans = [[{"kind": rules[k].kind, "start": a, "end": b, "base": rules[k].kind in base} for a, k, b in scanner.scan(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], names=["id", "spans"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, spans array<struct<kind string, start long, end long, base boolean>>")


@query("op4_secrets")
def op4_secrets(spark, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan_documents(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), *[count(r.kind) for r in BASE],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
