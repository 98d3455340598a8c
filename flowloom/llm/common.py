"""What the operators share: words, tables written to the shared folder, fixed hashes of ids."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, as a regular expression (space and the control characters 9 to 13).
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Rows, and bytes of one column, that Python works on at once: what it derives from a text is many times the text.
SLICE_ROWS, SLICE_BYTES = 500, 1 << 19


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column | str) -> Column:
    """The words of a text in order; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def id_bucket(doc_id: Column | str, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (a null id counts as empty text)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets).cast("int")


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def slices(batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in order, in pieces of at most ``rows`` rows and ``size`` bytes of a text or binary column; a longer value is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        end = min(max(fit, at + 1), at + rows)
        yield batch.slice(at, end - at)
        at = end


#: Folders made for sessions on one machine that name none, by application.
_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session on one machine that leaves it unset gets a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="flowloom-llm-")
        context.setCheckpointDir(_OWN_FOLDERS[context.applicationId])
    return _OWN_FOLDERS[context.applicationId]


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, so a lost executor costs
    no recomputation of what led to it. The files go with :func:`release`, or when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing reads any more; other frames are left alone."""
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path:
            place, files = _place(table.sparkSession, path)
            files.delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
