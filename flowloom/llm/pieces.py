"""Exact encoding with a merge-type piece vocabulary (SentencePiece BPE), by backtracking, and decoding.

* Longest matches. One Aho-Corasick pass over a stretch gives the longest piece that starts at each of its characters.
* Compatibility. A sequence of pieces is what merging yields exactly if every two neighbours are what merging their joined text yields: a
  merge across a border would show up in that pair already. So neighbours are tested by running the merges of both pieces side by side
  and watching the border; answers are kept in a table of at most 2 * ``KEPT`` pairs.
* Backtracking. The encoder takes the longest match, then shorter ones, that fit the piece before. Where none fits, the position is marked in a
  bitfield of failed positions, never to be tried again, and the piece before is shortened. So the work is linear in the stretch.

Merging takes the pair of neighbours whose joined piece has the best score, the leftmost of equals. Pieces that merging cannot reach are never
encoded. A character without a piece becomes its UTF-8 bytes. Where no piece of the vocabulary has a blank behind another character, texts
are cut before blanks; stretches up to ``SHORT`` characters are remembered (at most ``KEPT``), so words are encoded once per worker.

The vocabulary is read on the driver from ``path`` and broadcast; its size does not depend on the data. Supported are BPE models with byte fallback,
identity normalisation, a blank put in front and blanks written as U+2581, no user-defined pieces; others are refused.

Defined results: a null text is empty and has the end id only; repeated rows are encoded alike; an empty table gives an empty result; other
columns are ignored. Decoding follows the library: U+2581 becomes a blank, the blank put in front goes, malformed bytes become U+FFFD each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed kinds of pieces in the model format
BPE = 2
SHORT, KEPT = 48, 1 << 18
NEVER = float("-inf")


class Pieces:
    """Encoder and decoder of one vocabulary: (piece, score, kind) by id."""

    def __init__(self, table: list[tuple[str, float, int]], end_id: int):
        self.table, self.end_id = table, end_id
        self.score = {piece: score for piece, score, kind in table if kind == NORMAL}
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(table) if kind == NORMAL and self.merged(piece) == [piece]}
        self.built = None

    def merged(self, text: str, steps: list[tuple[float, str, str]] | None = None) -> list[str]:
        """Merging as defined: best score first, leftmost of equals. ``steps`` collects each merge's score with the first and last part before it."""
        parts, score = list(text), self.score
        scores = [score.get(x + y) for x, y in zip(parts, parts[1:])]  # noqa: B905
        while True:
            best = at = None
            for i, own in enumerate(scores):
                if own is not None and (best is None or own > best):
                    best, at = own, i
            if steps is not None:
                steps.append((NEVER if at is None else best, parts[0], parts[-1]))
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score.get(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = score.get(parts[at] + parts[at + 1])

    def ends(self, piece: int) -> tuple[list[tuple[float, str]], list[tuple[float, str]]]:
        """How merging makes a piece, step by step: the next merge's score with the first part, and with the last part."""
        found = self.made.get(piece)
        if found is None:
            steps: list[tuple[float, str, str]] = []
            self.merged(self.table[piece][0], steps)
            found = self.made[piece] = [(s, x) for s, x, _ in steps], [(s, y) for s, _, y in steps]
        return found

    def build(self) -> Pieces:
        """What each worker makes for itself: automaton, next shorter pieces, bytes of ids."""
        if self.built is None:
            self.automaton = ahocorasick.Automaton()
            for piece, i in self.ids.items():
                self.automaton.add_word(piece, (i, len(piece) - 1))
            self.automaton.make_automaton()
            self.size = [len(p) for p, *_ in self.table]
            self.shorter = [-1] * len(self.table)
            for piece, i in self.ids.items():
                self.shorter[i] = next((self.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), -1)
            self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(self.table) if kind == BYTE}
            self.bytes = [
                bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(BLANK, " ").encode()
                for p, _, kind in self.table]
            self.is_byte = {i for i, (_, _, kind) in enumerate(self.table) if kind == BYTE}
            blanks_first = all(BLANK not in p.lstrip(BLANK) for p in self.ids)
            self.stretches = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if blanks_first else "(?s).+")
            self.names = [str(i) for i in range(len(self.table))]
            self.made: dict[int, tuple[list[tuple[float, str]], list[tuple[float, str]]]] = {}  # at most one entry a piece
            self.fitting: dict[int, bool] = {}  # by first * number of pieces + second
            self.known: dict[str, tuple[list[int], str]] = {}  # stretches met lately,
            self.older: dict[str, tuple[list[int], str]] = {}  # and before those
            self.built = True
        return self

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces yields the two: each side merges as it does alone, the better next merge
        first, the left one of equals, unless the pair across the border comes before both."""
        score, left, right = self.score, self.ends(a)[1], self.ends(b)[0]
        i = j = 0
        while True:
            x, last = left[i]
            y, first = right[j]
            across = score.get(last + first)
            if across is not None and across > x and across >= y:
                return False
            if x < y:
                j += 1
            elif x == NEVER:
                return True
            else:
                i += 1

    def stretch(self, text: str) -> list[int]:
        longest = [-1] * len(text)
        for end, (piece, before) in self.automaton.iter(text):
            longest[end - before] = piece  # later ends are longer
        if -1 not in longest:
            return self.backtracked(longest, 0, len(text))
        out: list[int] = []
        begin = 0
        while begin < len(text):
            if longest[begin] < 0:
                out += [self.byte_ids[b] for b in text[begin].encode("utf-8", "surrogatepass")]
                begin += 1
                continue
            try:
                end = longest.index(-1, begin)
            except ValueError:
                end = len(text)
            out += self.backtracked(longest, begin, end)
            begin = end
        return out

    def backtracked(self, longest: list[int], begin: int, end: int) -> list[int]:
        """The pieces of a stretch of characters that all have pieces."""
        size, shorter, fitting, count = self.size, self.shorter, self.fitting, len(self.table)
        last = longest[begin]
        at = begin + size[last]
        if at == end:
            return [last]
        taken = [last]
        clean = True  # most stretches have no failed position
        failed = 0  # a bitfield over positions
        long_failed = bytearray((end - begin >> 3) + 1) if end - begin > 512 else None
        piece = longest[at]
        while True:
            while piece >= 0:
                to = 0 if clean else at + size[piece] - begin
                if clean or not (failed >> to & 1 if long_failed is None else long_failed[to >> 3] >> (to & 7) & 1):
                    if last < 0:
                        break
                    found = fitting.get(last * count + piece)
                    if found is None:
                        if len(fitting) >= 2 * KEPT:
                            fitting.clear()
                        found = fitting[last * count + piece] = self.fits(last, piece)
                    if found:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at += size[piece]
                if at == end:
                    return taken
                last, piece = piece, longest[at]
                continue
            clean = False
            if long_failed is None:
                failed |= 1 << at - begin
            else:
                long_failed[at - begin >> 3] |= 1 << (at - begin & 7)
            piece = taken.pop()
            at -= size[piece]
            last = taken[-1] if taken else -1

    def encoded(self, text: str | None) -> tuple[list[int], list[str]]:
        """The ids without the end id, and the same as decimal numbers joined by blanks, in parts."""
        ids: list[int] = []
        shown: list[str] = []
        if not text:
            return ids, shown
        known, older, names = self.known, self.older, self.names
        for stretch in self.stretches.findall(BLANK + text.replace(" ", BLANK)):
            found = known.get(stretch)
            if found is None:
                found = older.get(stretch)
                if found is None:
                    own = self.stretch(stretch)
                    found = own, " ".join([names[i] for i in own])
                if len(stretch) <= SHORT:
                    if len(known) >= KEPT:
                        self.older = older = known
                        self.known = known = {}
                    known[stretch] = found
            ids += found[0]
            shown.append(found[1])
        return ids, shown

    def decoded(self, ids: list[int]) -> str:
        data = b"".join([self.bytes[i] for i in ids])
        first = next((i for i in ids if self.table[i][2] != CONTROL), None)
        cut = first is not None and self.table[first][0].startswith(BLANK)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._with_malformed(ids)
        return text[1:] if cut else text

    def _with_malformed(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.is_byte:
                run += self.bytes[i]
                continue
            at = 0
            while at < len(run):
                for n in range(1, 5):
                    try:
                        out.append(run[at:at + n].decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()
            if i >= 0:
                out.append(self.bytes[i].decode())
        return "".join(out)


def load(path: str) -> Pieces:
    """The vocabulary of a model file on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as model
    proto = model.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    kinds = {p.type for p in proto.pieces}
    if trained.model_type != BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path}: not a BPE model with byte fallback and plain pieces")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or proto.denormalizer_spec.precompiled_charsmap:
        raise ValueError(f"{path}: its normalisation is not supported")
    return Pieces([(p.piece, p.score, p.type) for p in proto.pieces], trained.eos_id)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """(id, n_tokens, ids, ids_sha256, decoded, decoded_sha256): the ids of every whole text with the end id, and the text decoded
    from them; ``ids`` and ``decoded`` are filled if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.build()
        for batch in batches:
            n, all_ids, digests, texts, text_digests = [], [], [], [], []
            for value in batch.column("text"):
                ids, shown = pieces.encoded(value.as_py())
                ids.append(pieces.end_id)
                shown.append(str(pieces.end_id))
                text = pieces.decoded(ids)
                n.append(len(ids))
                digests.append(hashlib.sha256(" ".join(shown).encode()).hexdigest())
                text_digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                all_ids.append(ids if with_ids else None)
                texts.append(text if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(all_ids, pa.list_(pa.int32())), pa.array(digests), pa.array(texts, pa.string()), pa.array(text_digests)],
                names=["id", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"])
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_tokens long, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string")


def decode_documents(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of an array of ids (null: null); a column of that name is replaced."""
    rows = rows.drop("decoded")
    shared = rows.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.build()
        for batch in batches:
            texts = [None if ids is None else pieces.decoded(ids) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])
    return rows.mapInArrow(run, rows.select("*", F.lit("").alias("decoded")).schema)


@query("op11_pieces")
def op11_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False, with_text=False)
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
