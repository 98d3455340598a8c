"""Topic to datasource routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.fields import ROUTES
from flowloom.operators.counters import datasource_name


def route(df: DataFrame, use_namespace: bool = True, topic: str = "topic",
          namespace: str = "namespace_uuid") -> DataFrame:
    """Add ``target`` and ``datasource``; both are NULL for a topic that is not indexed."""
    pairs = lambda i: F.create_map(*[F.lit(v) for r in ROUTES for v in (r[0], r[i])])
    known = df.withColumns({
        "target": F.try_element_at(pairs(1), F.col(topic)), "_base": F.try_element_at(pairs(2), F.col(topic))})
    name = datasource_name(F.col("_base"), F.col(namespace), use_namespace)
    return known.withColumn("datasource", F.when(F.col("_base").isNotNull(), name)).drop("_base")


def split_routes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Routed rows and rejects of :func:`route`."""
    return df.filter(F.col("target").isNotNull()), df.filter(F.col("target").isNull()).drop("target", "datasource")
