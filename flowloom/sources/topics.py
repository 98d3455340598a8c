"""JSON topics: parse with rejects, keyed output, batch and streaming readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tie-breaker that every as-of operator takes: the order in which messages of one key arrived.
SEQUENCE = "event_id"
EXTRAS = "extras"


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with every number, truth value and date as text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _as_text(kind.valueType))
    return T.StringType()


def _typed(value: Column, kind: T.DataType) -> Column:
    """A value of :func:`_as_text` shape as ``kind``; text that is no number of the kind becomes NULL."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.StructType):
        fields = [_typed(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _typed(x, kind.valueType))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(value.try_cast(kind), value.try_cast("double").try_cast(kind))
    return value.try_cast(kind)


def parse_json(df: DataFrame, schema: str, value: str = "value", extras: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split raw messages into typed rows and rejects.

    A message is accepted when its text is one JSON object, whatever its fields hold: numbers may be written as
    text, and a value that does not fit its type is NULL without harm to the rest. With ``extras`` the fields
    outside ``schema`` stay, as text, in a map of that name. Other columns of ``df`` are kept beside the parsed
    fields; rejects keep the raw text.
    """
    others = [c for c in df.columns if c != value]
    kinds = T.StructType.fromDDL(schema)
    text = F.col(value).cast("string")
    # a generator's row is parsed once; conditions on a plain column would be moved below it and parse the text once more for each of them
    parsed = df.select(*others, text.alias("_raw"), F.explode(F.array(F.from_json(text, "map<string,string>"))).alias("_m"))
    # the map reader stops at the end of the object; a bad or cut-off text has no map
    ok = F.coalesce(F.col("_raw").rlike(r"^\s*\{") & F.col("_m").isNotNull(), F.lit(False))
    taken = set(others)

    def field(f: T.StructField) -> Column:
        own = F.try_element_at("_m", F.lit(f.name))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            own = F.from_json(own, _as_text(f.dataType))
        return _typed(own, f.dataType).alias(f.name)
    wanted = [field(f) for f in kinds.fields if f.name not in taken]
    known = [f.name for f in kinds.fields]
    if extras:
        wanted.append(F.map_filter("_m", lambda k, v: ~k.isin(known) & v.isNotNull()).alias(EXTRAS))
    good = parsed.filter(ok).select(*others, *wanted)
    bad = parsed.filter(~ok).select(*others, F.col("_raw").alias(value))
    return good, bad


def with_extras(df: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """Columns for those of ``names`` that the schema lacked and the ``extras`` map may hold."""
    if EXTRAS not in df.columns:
        return df
    return df.withColumns({n: F.try_element_at(EXTRAS, F.lit(n)) for n in names if n not in df.columns})


def read_topic(spark: SparkSession, location: str, fmt: str = "text", streaming: bool = False,
               **options: str) -> DataFrame:
    """Raw ``value`` column of a topic: a directory of JSON lines, or ``fmt="kafka"`` with its options.

    For Kafka ``location`` is the topic name and the connector must be on the class path; ``partition``, ``offset`` and
    the sequence column made of them come along. Messages of one key share a partition, so the sequence gives their order.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        frame = reader.format("kafka").options(subscribe=location, **options).load()
        order = F.shiftleft(F.col("partition").cast("bigint"), 48).bitwiseOR(F.col("offset"))
        return frame.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                            "partition", "offset", order.alias(SEQUENCE))
    return reader.format(fmt).options(**options).load(location)


def keyed_output(df: DataFrame, key: Column | None = None) -> DataFrame:
    """``(key, value)`` with the row as JSON; location topics are keyed by client MAC, others unkeyed."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select((key if key is not None else F.lit(None)).cast("string").alias("key"), body.alias("value"))


def write_topic(df: DataFrame, location: str, fmt: str = "parquet", mode: str = "append",
                partition_by: tuple[str, ...] = (), checkpoint: str | None = None, trigger: dict | None = None,
                **options: str):
    """Write a batch, or start a streaming write that resumes from ``checkpoint``."""
    if df.isStreaming:
        writer = df.writeStream.format(fmt).options(**options).outputMode(mode)
        if checkpoint:
            writer = writer.option("checkpointLocation", checkpoint)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer = writer.trigger(**(trigger or {"processingTime": "60 seconds"}))
        return writer.option("topic", location).start() if fmt == "kafka" else writer.start(location)
    writer = df.write.format(fmt).options(**options).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("topic", location).save() if fmt == "kafka" else writer.save(location)
