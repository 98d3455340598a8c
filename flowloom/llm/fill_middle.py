"""Fill-in-the-middle transformation by displacement scatter, and its inverse.

Every text is cut twice into prefix, middle and suffix and laid out anew around three marks. A batch is one array of bytes:

* Scan: the code points of a batch are counted in windows of bytes, which turns cuts in code points into byte positions.
* Displacement: a difference array holds, where a segment starts, how much its shift to the output differs from the shift before; its
  running sum is every byte's shift, and one numpy scatter builds the outputs of all texts of the batch.
* Restore: the marks' places in output and form give the segments back; the same running sum, over the restored text, is a gather.

Work is done in windows of ``WINDOW`` bytes with the shift carried on, so that a very long text needs no more memory than its own
bytes a few times over; batches are handled in slices of about ``SLICE`` bytes. The operator is one map over the rows.

Forms: ``plain`` where the text is empty or contains a mark or the hash of the id says so, else ``spm`` or ``psm``. All draws come from
SHA-256 of ``<seed>:<id>``, so that reruns and lost executors change nothing.

Defined results: a null text is empty, hence plain; a null id draws as an empty one; rows with equal ids draw alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents

WINDOW, SLICE = 1 << 20, 4 << 20
MARK = 3  # bytes of each mark: <P>, <S>, <M>
FORMS = ("plain", "psm", "spm")
PLAIN_FROM, SPM_BELOW, SEED = 90, 20, 1


def point_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position of ``at`` (ascending)."""
    out, done, i = np.zeros(len(at), np.int64), 0, 0
    for a in range(0, max(1, len(data)), WINDOW):
        part = (data[a:a + WINDOW] & 0xC0) != 0x80
        b = a + len(part)
        j = int(np.searchsorted(at, b, side="left")) if b < len(data) else len(at)
        before = np.concatenate(([0], np.cumsum(part)))
        out[i:j] = done + before[at[i:j] - a]
        done, i = done + int(before[-1]), j
    return out


def point_places(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The byte positions at which code points (ascending numbers) start; the end of the data for those behind the last."""
    out, done, i = np.full(len(points), len(data), np.int64), 0, 0
    for a in range(0, len(data), WINDOW):
        starts = np.flatnonzero((data[a:a + WINDOW] & 0xC0) != 0x80)
        j = int(np.searchsorted(points, done + len(starts), side="left"))
        out[i:j] = a + starts[points[i:j] - done]
        done, i = done + len(starts), j
    return out


def marks_in(data: np.ndarray) -> np.ndarray:
    """Where ``<P>``, ``<S>`` or ``<M>`` starts."""
    found = []
    for a in range(0, len(data), WINDOW):
        part = data[a:a + WINDOW + MARK - 1]
        name = part[1:-1]
        found.append(a + np.flatnonzero((part[:-2] == 60) & (part[2:] == 62) & ((name == 80) | (name == 83) | (name == 77))))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def displaced(source: np.ndarray, out: np.ndarray, starts: np.ndarray, shifts: np.ndarray, total: int, gather: bool) -> None:
    """``out[i + shift(i)] = source[i]``, or as gather ``out[i] = source[i + shift(i)]``; from starts[k] (ascending) on the shift is shifts[k]."""
    keep = np.append(starts[1:] != starts[:-1], True) if len(starts) else np.zeros(0, bool)  # of empty segments at one place the last counts
    starts, shifts = starts[keep], shifts[keep]
    change = np.diff(shifts, prepend=0)
    carried = 0
    for a in range(0, total, WINDOW):
        b = min(total, a + WINDOW)
        i, j = np.searchsorted(starts, (a, b))
        step = np.zeros(b - a, np.int64)
        step[starts[i:j] - a] = change[i:j]
        shift = np.cumsum(step) + carried
        carried = int(shift[-1])
        place = np.arange(a, b) + shift
        if gather:
            out[a:b] = source[place]
        else:
            out[place] = source[a:b]


def build(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> dict[str, np.ndarray]:
    """Outputs of the texts data[offsets[k]:offsets[k + 1]] for draws (h1, h2, h3, h4) per text."""
    begins, ends = offsets[:-1], offsets[1:]
    before = point_counts(data, offsets)
    n = np.diff(before)
    marks = marks_in(data)
    owner = np.searchsorted(offsets, marks, side="right") - 1
    marked = np.zeros(len(n), bool)
    marked[owner[marks + MARK <= ends[owner]]] = True
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= PLAIN_FROM)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < SPM_BELOW, 2, 1))
    one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    first, second = np.minimum(one, two), np.maximum(one, two)
    cuts = point_places(data, np.stack([before[:-1] + first, before[:-1] + second], axis=1).ravel()).reshape(-1, 2)
    p, s = np.minimum(cuts[:, 0], ends), np.minimum(cuts[:, 1], ends)
    lengths = ends - begins + np.where(plain, 0, 3 * MARK)
    out_offsets = np.concatenate(([0], np.cumsum(lengths)))
    o = out_offsets[:-1]
    psm, spm = form == 1, form == 2
    suffix = ends - s
    to_prefix = o + np.where(psm, MARK, np.where(spm, 2 * MARK + suffix, 0))
    to_suffix = o + np.where(psm, 2 * MARK + (p - begins), np.where(spm, MARK, s - begins))
    to_middle = o + np.where(plain, p - begins, 3 * MARK + (p - begins) + suffix)
    starts = np.stack([begins, p, s], axis=1).ravel()
    shifts = (np.stack([to_prefix, to_middle, to_suffix], axis=1) - np.stack([begins, p, s], axis=1)).ravel()
    out = np.empty(int(out_offsets[-1]), np.uint8)
    displaced(data, out, starts, shifts, len(data), gather=False)
    for place, name in ((to_prefix, 80), (to_suffix, 83), (to_middle, 77)):
        at = place[~plain] - MARK
        out[at], out[at + 1], out[at + 2] = 60, name, 62
    return {"n": n, "form": form, "prefix": first, "middle": second - first, "out": out, "offsets": out_offsets}


def restore(out: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts, from outputs and forms alone."""
    begins, ends = offsets[:-1], offsets[1:]
    cut = form > 0
    marks = marks_in(out)
    owner = np.searchsorted(offsets, marks, side="right") - 1
    places = np.zeros((len(form), 3), np.int64)
    places[cut] = marks[cut[owner] & (marks + MARK <= ends[owner])].reshape(-1, 3)  # a cut text has each mark once
    inner = places[:, 1:2] + MARK
    one, two, three = places[:, 0] + MARK, inner[:, 0], places[:, 2] + MARK
    psm = form == 1
    prefix, prefix_end = np.where(psm, one, two), np.where(psm, places[:, 1], places[:, 2])
    suffix, suffix_end = np.where(psm, two, one), np.where(psm, places[:, 2], places[:, 1])
    segments = [(np.where(cut, a, begins if k == 0 else ends), np.where(cut, b, ends)) for k, (a, b) in enumerate(((prefix, prefix_end), (three, ends), (suffix, suffix_end)))]
    lengths = np.stack([b - a for a, b in segments], axis=1)
    text_offsets = np.concatenate(([0], np.cumsum(lengths.sum(axis=1))))
    starts = text_offsets[:-1, None] + np.concatenate((np.zeros((len(form), 1), np.int64), np.cumsum(lengths, axis=1)[:, :2]), axis=1)
    shifts = np.stack([a for a, _ in segments], axis=1) - starts
    text = np.empty(int(text_offsets[-1]), np.uint8)
    displaced(out, text, starts.ravel(), shifts.ravel(), len(text), gather=True)
    return text, text_offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _offsets(texts: pa.LargeStringArray) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)


def _slices(texts: pa.LargeStringArray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about SLICE bytes."""
    sizes = np.cumsum(np.diff(_offsets(texts)))
    start = 0
    while start < len(texts):
        done = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + SLICE, side="right")))
        yield start, end
        start = end


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        for start, end in _slices(texts):
            rows, own = batch.slice(start, end - start), texts.slice(start, end - start)
            offsets = _offsets(own)
            data = np.frombuffer(own.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            draws = np.stack([rows.column(f"h{i}").to_numpy() for i in range(1, 5)], axis=1)
            made = build(data, offsets - offsets[0], draws)
            restored = restore(made["out"], made["offsets"], made["form"])
            whole = pa.array(made["form"] == 0)
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays([
                rows.column("id"), pa.array(made["n"]), pa.array([FORMS[k] for k in made["form"].tolist()], pa.string()),
                pa.compute.if_else(whole, none, pa.array(made["prefix"])), pa.compute.if_else(whole, none, pa.array(made["middle"])),
                _strings(made["out"], made["offsets"]), _strings(*restored),
            ], names=["id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """h1 to h4: the first four groups of eight digits of the id's SHA-256, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, restored), one row per document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *draws(F.col(id_col), seed))
    return rows.mapInArrow(_transform, f"id {dict(rows.dtypes)['id']}, n long, form string, prefix_chars long, middle_chars long, output string, restored string")


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT doc_id, t, n, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 AS plain,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 AS spm,
    least(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1)) AS a,
    greatest(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1)) AS b
  FROM d)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
  sha256(CASE WHEN plain THEN t
    WHEN spm THEN '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""


@query("op13_fill_middle", SQL)
def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    def digest(name: str) -> Column:
        return F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256")
    made = fill_in_middle(documents(spark, sf_dir))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
