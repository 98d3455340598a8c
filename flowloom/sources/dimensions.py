"""Dimension tables: vendor prefixes, threat lists, address ranges, site and salt tables, refresh."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: str) -> DataFrame:
    """An absent file gives an empty dimension, so lookups simply find nothing."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _file_order() -> Column:
    """Position of a row: file, place of its split in the file, row in the split."""
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())


def vendor_table(spark: SparkSession, path: str) -> DataFrame:
    """``(oui, vendor)`` of ``PREFIX|vendor`` lines; the last line of a prefix wins."""
    load = lambda: spark.read.text(path).select("value", _file_order().alias("line"))
    lines = _or_empty(spark, load, "value string, line int").select(F.split("value", r"\|").alias("t"), "line")
    rows = lines.select(F.get("t", F.lit(0)).alias("oui"), F.get("t", F.lit(1)).alias("vendor"), "line")
    return rows.filter(F.col("vendor").isNotNull()).groupBy("oui").agg(F.max_by("vendor", "line").alias("vendor"))


def threat_table(spark: SparkSession, path: str,
                 fields: str = "darklist_score int, darklist_score_name string, darklist_category string, darklist_protocol string") -> DataFrame:
    """Threat list of a JSON array ``[{ip, enrich_with: {...}}]``; the last entry of an address wins.

    One array is one JSON value and so read by one task; a long list is better given as several files.
    """
    nested = f"ip string, enrich_with struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in fields.split(','))}>"
    load = lambda: spark.read.schema(nested).option("multiLine", "true").json(path).select("*", _file_order().alias("_line"))
    return last_threat(_or_empty(spark, load, f"{nested}, _line int"), "_line")


def last_threat(entries: DataFrame, order: str) -> DataFrame:
    """One row per address with its last entry's fields as columns."""
    last = entries.filter(F.col("ip").isNotNull()).groupBy("ip").agg(F.max_by("enrich_with", order).alias("e"))
    return last.select("ip", "e.*")


def range_tables(spark: SparkSession, country_path: str | None, asn_path: str | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Country and network-owner ranges from parquet; a missing table is ``None``."""
    def load(path: str | None) -> DataFrame | None:
        if path is None:
            return None
        frame = _or_empty(spark, lambda: spark.read.parquet(path), "start_ip string")
        return frame if "end_ip" in frame.columns else None
    return load(country_path), load(asn_path)


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of the site database; pass ``partitionColumn`` and friends to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


class Refreshing:
    """A dimension that is loaded at the start and again after ``every`` window ticks.

    Call :meth:`tick` once per micro-batch or window; the first reload comes on the tick after ``every``
    full ones. The new snapshot replaces the old one, so vanished keys are gone.
    """

    def __init__(self, load: Callable[[], DataFrame], every: int = 5):
        self._load, self._every, self._ticks = load, every, 0
        self.loads = 0
        self.loaded_at = 0.0
        self.table = self._reload()

    def _reload(self) -> DataFrame:
        self.loads += 1
        self.loaded_at = time.time()
        return self._load()

    def tick(self) -> DataFrame:
        if self._ticks == self._every:
            self.table, self._ticks = self._reload(), 0
        self._ticks += 1
        return self.table
