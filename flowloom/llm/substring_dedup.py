"""Substring deduplication: word windows that start earlier elsewhere are found with FM-indexes over shards.

A shard holds every stretch of text that could match another one in it, so no document needs to be streamed through all shards:

1. Blocks. Documents are dealt into blocks of about ``BLOCK_BYTES`` by a hash of their id and text, one shuffle that later steps reuse.
2. Minimisers. The smallest hash among the ``GRAM``-word grams of a window names it; equal windows have equal names, and neighbouring
   windows mostly share one (about one name per eight words). A name seen once in the whole corpus cannot repeat: only names that
   occur twice are answered to the blocks.
3. Shards. Stretches of windows with a repeated name go, as text, to the shard of that name, each different stretch of a block once and with
   its earliest place only: the block's other places of it are known to be repeats and stay where they are. So a passage that a third of all
   documents share sends one row per block. Names with more than ``HOT`` different stretches are split into single windows dealt by their own hash.
4. Index. Each shard builds an FM-index (wavelet matrix over the Burrows-Wheeler column) of its distinct stretches and streams them
   through it: backward search yields, per window, the interval of equal windows; the smallest (doc_id, text hash, start) there is the one that stays.
5. The verdicts go back to the blocks, where the words are taken out.

Words are compared as text from step 3 on, so hashes only route. Groups are bounded: a block by bytes, a shard by the number of shards (two per
block), the pre-aggregation and the splitting of step 3.

Defined results: a null text has no words; a null id sorts after all others; rows that share an id are one document only
if their texts are equal too (else the smaller text hash counts as the earlier document), and equal rows keep the same words; texts below
``WINDOW`` words lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store
from flowloom.llm.fmindex import FmIndex

WINDOW, GRAM = 20, 6
BLOCK_BYTES, HOT = 4 << 20, 20_000
LAST_ID = (1 << 63) - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
REMEMBERED = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_SEEN = _Hashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Block:
    """The words of a block's documents in one row, in order of id, with window names and hashes."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        table = table.sort_by([("id", "ascending"), ("mark", "ascending")])
        self.ids, self.marks = table.column("id").to_numpy(), table.column("mark").to_numpy()
        self.words: list[bytes] = []
        counts = []
        for text in table.column("text").to_pylist():
            found = (text or "").encode("utf-8", "surrogatepass").split()
            self.words += found
            counts.append(len(found))
        self.counts = np.array(counts, np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.counts)))
        self.window, self.gram = window, gram
        self.n = len(self.words)

    def names(self) -> None:
        """Per window start: its name (smallest gram hash), its own hash, whether it lies in one document."""
        n, window, gram = self.n, self.window, self.gram
        size = max(0, n - window + 1)
        if not size:
            self.name = self.own = np.zeros(0, np.uint64)
            self.near = np.zeros(0, np.uint64)
            self.stretches = np.zeros((0, 2), np.int64)
            self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
            return
        h = np.fromiter(map(_SEEN.__getitem__, self.words), np.uint64, n)
        power = np.full(n + 1, BASE)
        power[0] = 1
        power = np.cumprod(power)
        back = np.full(n + 1, INVERSE)
        back[0] = 1
        back = np.cumprod(back)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[:n])))
        grams = _mixed((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
        self.own = _mixed((sums[window:] - sums[:-window]) * back[:size])
        width, least = 1, grams
        span = window - gram + 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        self.name = np.minimum(least[:size], least[span - width:span - width + size])
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        inside = doc[:size] == doc[window - 1:]
        new = np.concatenate(([True], (self.name[1:] != self.name[:-1]) | (doc[1:size] != doc[:size - 1])))
        first = np.flatnonzero(new & inside)
        ends = np.concatenate((np.flatnonzero(new | ~inside), [size]))
        after = ends[np.searchsorted(ends, first, side="right")]
        self.stretches = np.stack([first, after], axis=1)  # windows first .. after - 1
        # grams that come again within a window's reach: their stretches may repeat a window in themselves
        near = np.zeros(len(grams), bool)
        for k in range(1, min(span, len(grams) - 1) + 1):
            near[:-k] |= grams[k:] == grams[:-k]
        self.near = np.unique(grams[near])
        self.doc = doc


def _names(window: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        block = Block(table, window, gram)
        block.names()
        first, after = block.stretches[:, 0], block.stretches[:, 1]
        kinds = np.stack([block.name[first], block.own[first] + (after - first).astype(np.uint64)], axis=1)
        distinct, times = np.unique(kinds, axis=0, return_counts=True) if len(kinds) else (kinds, np.zeros(0, np.int64))
        name, at = np.unique(distinct[:, 0], return_index=True)
        different = np.diff(np.append(at, len(distinct)))
        all_times = np.add.reduceat(times, at) if len(at) else times
        # the name's different stretches in this block; -1 says that one stretch comes several times, or repeats in itself
        weight = np.where(((all_times > 1) | np.isin(name, block.near)) & (different == 1), -1, different)
        return pa.table({"name": name.view(np.int64), "block": np.full(len(name), table.column("block")[0].as_py(), np.int32), "n": weight.astype(np.int32)})
    return run


def _repeated(batches):
    """Of rows sorted by name, those whose name occurs again; ``hot`` where it has more than HOT different stretches."""
    held: list[np.ndarray] = []

    def out(name, block, n):
        cuts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        lengths = np.diff(np.append(cuts, len(name)))
        again = (lengths > 1) | (n[cuts] != 1)
        keep = np.repeat(again, lengths)
        hot = np.repeat(np.add.reduceat(np.abs(n).astype(np.int64), cuts) > HOT, lengths)
        return pa.RecordBatch.from_arrays([pa.array(name[keep]), pa.array(block[keep]), pa.array(hot[keep])], names=["name", "block", "hot"])

    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("name", "block", "n")]
        if held:
            columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1]))
        held = [c[last:].copy() for c in columns]  # a name has at most one row per block
        if last:
            yield out(*[c[:last] for c in columns])
    if held and len(held[0]):
        yield out(*held)


#: A block's distinct stretch: its shard, number in the block, words, earliest place, and all its places as (row, start) in the block.
STRETCH = "shard int, block int, no int, words binary, id long, mark long, start int, windows int, rows binary, starts binary"


def _stretches(window: int, gram: int, shards: int):
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in STRETCH.split(", "))])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return schema.empty_table()
        number = table.column("block")[0].as_py()
        block = Block(table, window, gram)
        block.names()
        wanted = answers.column("name").to_numpy().view(np.uint64)
        hot = np.sort(wanted[answers.column("hot").to_numpy(zero_copy_only=False)])
        wanted = np.sort(wanted)

        def among(values, of):
            if not len(of):
                return np.zeros(len(values), bool)
            return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values

        name = block.name[block.stretches[:, 0]]
        chosen, names = block.stretches[among(name, wanted)], name[among(name, wanted)]
        is_hot = among(names, hot)
        plain, route = chosen[~is_hot], names[~is_hot]
        if is_hot.any():  # single windows, dealt by their own hash
            single = np.concatenate([np.arange(a, b) for a, b in chosen[is_hot].tolist()])
            plain = np.concatenate((plain, np.stack([single, single + 1], axis=1)))
            route = np.concatenate((route, block.own[single]))
        shard = (_mixed(route) % np.uint64(shards)).astype(np.int32).tolist()
        places: dict[tuple[int, bytes], list[int]] = {}
        words = block.words
        for s, (a, b) in zip(shard, plain.tolist(), strict=True):
            places.setdefault((s, b" ".join(words[a:b + window - 1])), []).append(a)
        out: dict[str, list] = {f.name: [] for f in schema}
        for no, ((s, text), at) in enumerate(places.items()):
            at = np.array(at)  # ascending, so the earliest place (id, mark, start) comes first
            row = block.doc[at]
            start = (at - block.offsets[row]).astype(np.int32)
            for name, value in zip(out, (s, number, no, text, int(block.ids[row[0]]), int(block.marks[row[0]]), int(start[0]), text.count(b" ") + 2 - window,
                                         row.astype(np.int32).tobytes(), start.tobytes()), strict=True):
                out[name].append(value)
        return pa.table(out, schema)
    return run


#: What a shard says about a block's stretches: numbers of those repeated as a whole, and (number, offset) of single repeated windows.
VERDICT = "block int, whole binary, nos binary, offsets binary"


def _index(window: int):
    schema = pa.schema([("block", pa.int32()), *[(c, pa.binary()) for c in ("whole", "nos", "offsets")]])

    def run(table: pa.Table) -> pa.Table:
        words = table.column("words").combine_chunks()
        coded = words.dictionary_encode()
        kind = coded.indices.to_numpy().astype(np.int64)
        block, no, ids, marks, starts = (table.column(c).to_numpy() for c in ("block", "no", "id", "mark", "start"))
        # the distinct stretches as symbols, each ended by 0
        symbols: dict[bytes, int] = {}
        text: list[int] = []
        distinct = coded.dictionary.to_pylist()
        lengths = np.zeros(len(distinct), np.int64)
        for k, stretch in enumerate(distinct):
            found = stretch.split()
            lengths[k] = len(found)
            text += [symbols.setdefault(w, len(symbols) + 1) for w in found]
            text.append(0)
        text = np.array(text, np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        # earliest place of each stretch; every other place of it repeats all its windows
        order = np.lexsort((starts, marks, ids, kind))
        new = np.concatenate(([True], kind[order][1:] != kind[order][:-1]))
        earliest = order[new]
        copied = np.ones(len(kind), bool)
        copied[earliest] = False
        at, interval = FmIndex(text, window).matching(offsets, lengths)
        owner = np.searchsorted(offsets, at, side="right") - 1
        offset = at - offsets[owner]
        row = earliest[owner]
        from_id, from_mark, from_start = ids[row], marks[row], starts[row] + offset
        order = np.lexsort((from_start, from_mark, from_id, interval))
        new = np.concatenate(([True], interval[order][1:] != interval[order][:-1])) if len(order) else np.zeros(0, bool)
        head = order[new][np.cumsum(new) - 1]  # the earliest window of each interval
        repeats = (from_id[order] != from_id[head]) | (from_mark[order] != from_mark[head]) | (from_start[order] != from_start[head])
        gone = order[repeats]
        of_blocks: dict[int, list] = {}
        for slot, rows, extra in ((0, np.flatnonzero(copied), None), (1, row[gone], offset[gone])):
            order = np.argsort(block[rows], kind="stable")
            rows = rows[order]
            cuts = np.flatnonzero(np.concatenate(([True], block[rows][1:] != block[rows][:-1], [True]))) if len(rows) else np.zeros(1, np.int64)
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = of_blocks.setdefault(int(block[rows[i]]), [b"", b"", b""])
                own[slot] = no[rows[i:j]].astype(np.int32).tobytes()
                if extra is not None:
                    own[2] = extra[order[i:j]].astype(np.int32).tobytes()
        return pa.table({"block": list(of_blocks), **{c: [own[i] for own in of_blocks.values()] for i, c in enumerate(("whole", "nos", "offsets"))}}, schema)
    return run


def _remove(window: int, gram: int):
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def ranges(block: Block, found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Where repeated words start and end, from the block's places and the shards' verdicts."""
        is_place = found.column("no").is_valid().to_numpy()
        own = found.filter(pa.array(is_place)).sort_by("no")
        verdicts = found.filter(pa.array(~is_place))
        if not own.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = {c: np.frombuffer(b"".join(own.column(c).to_pylist()), np.int32).astype(np.int64) for c in ("rows", "starts")}
        times = np.array([len(x) // 4 for x in own.column("rows").to_pylist()])
        first = np.concatenate(([0], np.cumsum(times)))[:-1]
        windows = own.column("windows").to_numpy().astype(np.int64)
        number = np.repeat(np.arange(len(times)), times)
        row, start = joined["rows"], joined["starts"]
        head = first[number]
        as_head = (block.ids[row] == block.ids[row[head]]) & (block.marks[row] == block.marks[row[head]]) & (start == start[head])
        packed = {c: np.frombuffer(b"".join(verdicts.column(c).to_pylist()), np.int32).astype(np.int64) for c in ("whole", "nos", "offsets")}
        whole = np.zeros(len(times), bool)
        whole[packed["whole"]] = True  # numbers run from 0 without gaps
        gone = ~as_head | whole[number]
        begin = block.offsets[row] + start
        starts, ends = [begin[gone]], [(begin + windows[number] + window - 1)[gone]]
        # the places that are the head, or equal rows of the table, lose the head's windows
        heads = np.flatnonzero(as_head & ~gone)
        per = np.bincount(number[heads], minlength=len(times))
        upto = np.concatenate(([0], np.cumsum(per)))
        for k in range(int(per.max()) if len(per) else 0):
            some = per[packed["nos"]] > k
            place = heads[upto[packed["nos"][some]] + k]
            starts.append(begin[place] + packed["offsets"][some])
            ends.append(begin[place] + packed["offsets"][some] + window)
        return np.concatenate(starts), np.concatenate(ends)

    def run(table: pa.Table, found: pa.Table, with_text: bool) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        block = Block(table, window, gram)
        begins, ends = ranges(block, found)
        change = np.bincount(begins, minlength=block.n + 1) - np.bincount(ends, minlength=block.n + 1)
        gone = np.cumsum(change[:-1]) > 0
        totals = np.concatenate(([0], np.cumsum(gone)))
        removed = totals[block.offsets[1:]] - totals[block.offsets[:-1]]
        digests, kept = [], []
        for i, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True)):
            words = block.words[a:b]
            if removed[i]:
                words = list(compress(words, (~gone[a:b]).tolist()))
            joined = b" ".join(words)
            digests.append(hashlib.sha256(joined).hexdigest())
            kept.append(joined.decode("utf-8", "surrogatepass") if with_text else None)
        ids = pa.array(block.ids, pa.int64(), mask=block.ids == LAST_ID)
        return pa.table({"id": ids, "n_words": block.counts, "n_removed": removed, "kept_sha256": digests, "kept": pa.array(kept, pa.string())}, schema)
    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept): one row per document; ``kept`` is the remaining text if asked for."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    shards = 2 * blocks
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    mark = F.xxhash64(text_col)
    dealt = docs.select(F.pmod(F.xxhash64(key, mark), F.lit(blocks)).cast("int").alias("block"), key.alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    by_block = dealt.groupBy("block")
    names = by_block.applyInArrow(_names(window, gram), "name long, block int, n int")
    answers = names.repartition("name").sortWithinPartitions("name").mapInArrow(_repeated, "name long, block int, hot boolean")
    stretches = store(by_block.cogroup(answers.groupBy("block")).applyInArrow(_stretches(window, gram, shards), STRETCH), "stretches")
    verdicts = stretches.select("shard", "block", "no", "words", "id", "mark", "start").groupBy("shard").applyInArrow(_index(window), VERDICT)
    repeats = stretches.select("block", "no", "windows", "rows", "starts").unionByName(verdicts, allowMissingColumns=True)
    remove = _remove(window, gram)
    return by_block.cogroup(repeats.groupBy("block")).applyInArrow(
        lambda table, found: remove(table, found, with_text), "id long, n_words long, n_removed long, kept_sha256 string, kept string")


@query("op1_substring_dedup")
def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), with_text=False).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
