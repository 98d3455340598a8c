"""Per-minute rollups: a dimension list and aggregators per datasource."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.text import whole_number
from flowloom.operators.split import CHANGED

GRANULARITY = "1 minute"


@dataclass(frozen=True)
class RollupSpec:
    """``dims`` of ``None`` groups by every column except ``exclude`` and the metric inputs.

    ``aggs`` maps an output name to ``(kind, input)``; kinds are ``count``, ``lsum``, ``dsum``, ``min``,
    ``max``, ``distinct`` and ``histogram``. ``late`` is the accepted lateness. ``fill_time`` gives
    records without a timestamp their arrival time.
    """

    name: str
    dims: tuple[str, ...] | None
    aggs: dict[str, tuple[str, str | None]]
    late: str
    exclude: tuple[str, ...] = ()
    fill_time: bool = False


_EVENTS = {"events": ("count", None)}
_VALUE = {"sum_value": ("dsum", "value"), "max_value": ("max", "value"), "min_value": ("min", "value")}

# Dimensions, aggregators and late limit of every rollup.
FLOW = RollupSpec("flow", (
    "application_id_name", "conversation", "direction", "engine_id_name", "http_user_agent", "host",
    "http_social_media", "referer", "l4_proto", "ip_protocol_version", "sensor_name", "sensor_uuid",
    "deployment", "deployment_uuid", "namespace", "namespace_uuid", "sensor_ip", "scatterplot", "lan_ip",
    "lan_ip_country_code", "lan_ip_net_name", "lan_l4_port", "lan_ip_as_name", "client_mac", "client_id",
    "client_mac_vendor", "dot11_status", "lan_vlan", "src_map", "wan_ip", "wan_ip_country_code",
    "wan_ip_net_name", "wan_ip_as_name", "wan_l4_port", "wan_vlan", "dst_map", "lan_interface_name",
    "wan_interface_name", "tos", "client_latlong", "coordinates_map", "campus", "campus_uuid", "building",
    "building_uuid", "floor", "floor_uuid", "zone", "wireless_id", "client_rssi", "wireless_station",
    "market", "market_uuid", "organization", "organization_uuid", "type", "duration", "dot11_protocol",
    "service_provider", "service_provider_uuid", "zone_uuid", "https_common_name", "wireless_operator",
    "client_accounting_type", "interface_name", "client_fullname", "client_gender", "client_auth_type",
    "client_vip", "client_loyality", "host_l2_domain", "referer_l2", "selector_name", "tcp_flags",
    "product_name", "ip_country_code", "public_ip", "ip_as_name",
), {
    **_EVENTS, "sum_bytes": ("lsum", "bytes"), "sum_pkts": ("lsum", "pkts"),
    "sum_rssi": ("lsum", "client_rssi_num"), "clients": ("distinct", "client_mac"),
    "wireless_stations": ("distinct", "wireless_station"),
}, "15 minutes")

EVENT = RollupSpec("event", (
    "src", "dst", "src_port", "dst_port", "src_as_name", "src_country_code", "dst_map", "src_map",
    "service_provider", "sha256", "file_uri", "file_size", "file_hostname", "action", "ethlength_range",
    "icmptype", "ethsrc", "ethsrc_vendor", "ethdst", "ethdst_vendor", "ttl", "vlan", "classification",
    "domain_name", "group_name", "sig_generator", "rev", "priority", "msg", "sig_id", "dst_country_code",
    "dst_as_name", "namespace", "deployment", "market", "organization", "campus", "building", "floor",
    "floor_uuid", "conversation", "iplen_range", "l4_proto", "sensor_name", "scatterplot", "src_net_name",
    "dst_net_name", "tos", "service_provider_uuid", "namespace_uuid", "market_uuid", "organization_uuid",
    "campus_uuid", "building_uuid",
), {**_EVENTS, "signatures": ("distinct", "msg")}, "10 minutes", fill_time=True)

STATE = RollupSpec("state", (
    "wireless_station", "type", "wireless_channel", "wireless_tx_power", "wireless_admin_state",
    "wireless_op_state", "wireless_mode", "wireless_slot", "sensor_name", "sensor_uuid", "deployment",
    "deployment_uuid", "namespace", "namespace_uuid", "organization", "organization_uuid", "market",
    "market_uuid", "floor", "floor_uuid", "zone", "zone_uuid", "building", "building_uuid", "campus",
    "campus_uuid", "service_provider", "service_provider_uuid", "wireless_station_ip", "status",
    "wireless_station_name",
), {
    **_EVENTS, "sum_value": ("dsum", "value"), "wireless_stations": ("distinct", "wireless_station"),
    "wireless_channels": ("distinct", "wireless_channel"), "sum_wireless_tx_power": ("lsum", "wireless_tx_power"),
}, "20 minutes")

SOCIAL = RollupSpec("social", (
    "client_latlong", "lan_ip_country_code", "sensor_uuid", "deployment", "deployment_uuid", "namespace",
    "namespace_uuid", "user_screen_name", "user_name", "user_id", "type", "hashtags", "mentions", "msg",
    "sentiment", "msg_send_from", "user_from", "user_profile_img_https", "influence", "picture_url",
    "language", "category", "followers", "floor", "floor_uuid", "campus", "campus_uuid", "building",
    "building_uuid", "service_provider", "service_provider_uuid", "market", "market_uuid", "organization",
    "organization_uuid", "sensor_name",
), {**_EVENTS, "users": ("distinct", "user_screen_name"), "sum_followers": ("lsum", "followers")}, "10 minutes")

HASHTAG = RollupSpec("hashtag", (
    "sensor_name", "sensor_uuid", "deployment", "deployment_uuid", "namespace", "namespace_uuid", "type",
    "value", "floor", "floor_uuid", "campus", "campus_uuid", "building", "building_uuid", "market",
    "market_uuid", "organization", "organization_uuid", "service_provider", "service_provider_uuid",
), _EVENTS, "10 minutes")

MALWARE = RollupSpec("malware", (
    "type", "sensor_name", "sensor_uuid", "deployment", "deployment_uuid", "namespace", "namespace_uuid",
    "market", "market_uuid", "organization", "organization_uuid", "service_provider",
    "service_provider_uuid", "email_sender", "email_destination", "email_id", "file_name", "url", "lan_ip",
    "ip_score", "url_score", "hash_score", "domain_name", "client_id", "client_mac", "hash", "wan_ip",
    "file_size", "status", "hash_probe_score", "ip_probe_score", "url_probe_score", "proxy_ip",
    "application_id_name",
), {**_EVENTS, "files": ("distinct", "hash")}, "10 minutes", fill_time=True)

MONITOR = RollupSpec("monitor", None, {**_EVENTS, **_VALUE}, "10 minutes", exclude=("unit", "type"))

LOCATION = RollupSpec("location", (
    "new", "old", "type", "transition", "service_provider_uuid", "organization_uuid", "deployment_uuid",
    "namespace_uuid", "market_uuid", "campus_uuid", "building_uuid", "floor_uuid", "zone_uuid",
    "client_latlong", "dot11_status", "client_profile", "sensor_uuid",
), {
    **_EVENTS, "sum_dwell_time": ("lsum", "dwell_time"), "sum_rssi": ("lsum", "client_rssi_num"),
    "sum_popularity": ("dsum", "popularity"), "sum_repetitions": ("lsum", "repetitions"),
    "clients": ("distinct", "client_mac"), "sessions": ("distinct", "session"),
    "hist_dwell": ("histogram", "dwell_time"),
}, "30 minutes")

IOC = RollupSpec("ioc", ("endpoint_uuid", "ioc", "action"), {
    **_EVENTS, "endpoints": ("distinct", "endpoint_uuid"), "iocs": ("distinct", "ioc"),
}, "10 minutes")

CHANGES = RollupSpec("changes", ("s3_old", "s3_new", "flow_type", "endpoint_uuid", "md5"), {
    **_EVENTS, "endpoints": ("distinct", "endpoint_uuid"),
}, "10 minutes")

IOT = RollupSpec("iot", (
    "sensor_uuid", "monitor", "value", "proxy_uuid", "deployment", "deployment_uuid", "namespace",
    "namespace_uuid", "market", "market_uuid", "organization", "organization_uuid", "client_latlong",
    "coordinates_map", "campus", "campus_uuid", "building", "building_uuid", "floor", "floor_uuid",
), {**_EVENTS, **_VALUE}, "10 minutes")

APPMOBILE_SIGNAL = RollupSpec("appmobile_signal", (
    "antennaType", "timezone", "IMEI", "CelIdentity", "countryCode", "mobileNetworkCode",
), {
    "min_signal_strength": ("min", "signalStrength"), "max_signal_strength": ("max", "signalStrength"),
    "sum_signal_strength": ("dsum", "signalStrength"), **_EVENTS,
}, "10 minutes")

APPMOBILE_CALL = RollupSpec("appmobile_call", ("timezone", "IMEI", "number", "type"), {
    "min_duration": ("min", "duration"), "max_duration": ("max", "duration"),
    "sum_duration": ("dsum", "duration"), **_EVENTS,
}, "10 minutes")

VAULT = RollupSpec("vault", (
    "pri", "pri_text", "syslogfacility", "syslogfacility_text", "syslogseverity", "syslogseverity_text",
    "hostname", "fromhost_ip", "app_name", "sensor_name", "proxy_uuid", "message", "status", "category",
    "source", "target", "sensor_uuid", "service_provider_uuid", "namespace_uuid", "deployment_uuid",
    "market_uuid", "organization_uuid", "campus_uuid", "building_uuid", "floor_uuid", "action",
), _EVENTS, "20 minutes")

SPECS = {s.name: s for s in (
    FLOW, EVENT, STATE, SOCIAL, HASHTAG, MALWARE, MONITOR, LOCATION, IOC, CHANGES, IOT, APPMOBILE_SIGNAL,
    APPMOBILE_CALL, VAULT,
)}

# Dwell-time histogram size and bounds in minutes.
HISTOGRAM_BINS, HISTOGRAM_LOW, HISTOGRAM_HIGH = 50, 3, 1440
HISTOGRAM_BUCKETS = 30

#: Size of the quantile sketch behind a histogram: ranks are off by RANK_ERROR of the values at most (99 %), merged or not.
SKETCH_SIZE, RANK_ERROR = 200, 0.02


def absent_dims(df: DataFrame, spec: RollupSpec) -> list[str]:
    """Dimensions of the specification that ``df`` lacks."""
    return [d for d in spec.dims or () if d not in df.columns]


def bucket(x: Column) -> Column:
    """Number of the histogram bin of a value between the bounds, else NULL."""
    at = F.floor((x - HISTOGRAM_LOW) * HISTOGRAM_BINS / (HISTOGRAM_HIGH - HISTOGRAM_LOW))
    return F.when(x.between(HISTOGRAM_LOW, HISTOGRAM_HIGH), F.least(at, F.lit(HISTOGRAM_BINS - 1).cast("bigint")))


def dims_of(df: DataFrame, spec: RollupSpec) -> list[str]:
    """Grouping columns present in ``df``; absent dimensions would be NULL throughout."""
    if spec.dims is not None:
        return [d for d in spec.dims if d in df.columns]
    metrics = {source for _, source in spec.aggs.values() if source}
    out = {"timestamp", "event_time", "window", "extras", *spec.exclude, *metrics}
    return [c for c in df.columns if c not in out]


def _expanding(df: DataFrame, spec: RollupSpec, dims: Sequence[str]) -> bool:
    """Whether exact distinct counts of the specification are over several columns, for which Spark would expand every row."""
    return len({c for kind, c in spec.aggs.values() if kind == "distinct" and c in df.columns and c not in dims}) > 1


def _aggregate(df: DataFrame, kind: str, source: str | None, name: str, mode: str, dims: Sequence[str] = (), sets: bool = False) -> list[Column]:
    if kind == "distinct" and mode == "exact" and source in dims:
        # a group has one value of its own dimension: no row is expanded to count it
        return [F.max(F.when(F.col(source).isNotNull(), 1).otherwise(0).cast("bigint")).alias(name)]
    if kind == "count":
        return [F.count(F.lit(1)).alias(name)]
    there = source in df.columns
    c = F.col(source) if there else F.lit(None)
    whole = F.lit(0).cast("bigint")
    if not there and (kind == "lsum" or kind == "distinct" and mode != "sketch"):
        return [F.max(whole).alias(name)]
    if kind == "lsum":
        return [F.coalesce(F.sum(c.try_cast("bigint")), whole).alias(name)]
    if kind == "dsum":
        return [F.coalesce(F.sum(c.try_cast("double")), F.lit(0.0)).alias(name)]
    if kind in ("min", "max"):
        return [getattr(F, kind)(c.try_cast("double")).alias(name)]
    if kind == "distinct":
        text = c.cast("string")
        if mode == "exact":
            # a set per group keeps one row per group and task, with no copy of the row for each column
            return [(F.size(F.collect_set(text)).cast("bigint") if sets else F.count_distinct(text)).alias(name)]
        if mode == "sketch":
            return [F.hll_sketch_agg(text).alias(name)]
        if df.isStreaming:
            return [F.approx_count_distinct(text).alias(name)]
        # a sketch grows with its values, where approx_count_distinct holds all its registers for a group of one row; it skips empty text
        return [F.hll_sketch_estimate(F.hll_sketch_agg(F.concat(F.lit("="), text))).alias(name)]
    if kind == "histogram":
        x = c.try_cast("double")
        inside = F.when(x.between(HISTOGRAM_LOW, HISTOGRAM_HIGH), x)
        parts = [
            F.count_if(x < HISTOGRAM_LOW).alias(f"{name}_below"),
            F.count_if(x > HISTOGRAM_HIGH).alias(f"{name}_above"),
        ]
        if mode == "exact":
            return parts + [F.count(inside).alias(f"{name}_inside")]
        # counts of fixed bins, so that histograms of several minutes add up
        at = bucket(x)
        bins = F.array(*[F.count_if(at == i) for i in range(HISTOGRAM_BINS)]).alias(name)
        # bins adapted to the values, as a sketch that merges
        return parts + [bins] + ([F.kll_sketch_agg_double(inside, F.lit(SKETCH_SIZE)).alias(f"{name}_sketch")] if mode == "sketch" else [])
    raise ValueError(f"unknown aggregator {kind}")


def event_seconds(df: DataFrame, spec: RollupSpec, now: Column | None = None) -> Column:
    """Epoch seconds of a record, NULL when it has none; ``fill_time`` rollups use the arrival time then."""
    seconds = whole_number(df, "timestamp")
    if spec.fill_time:
        seconds = F.coalesce(seconds, now if now is not None else F.unix_timestamp())
    return seconds


#: types whose text tells values apart exactly as grouping does
_TEXTUAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(), T.StringType())


class Apart:
    """Dimensions of whole records, kept apart from their slices.

    Slices share the dimensions that the split leaves alone. :meth:`take` puts a digest (half of a SHA-256 of values, lengths and
    NULLs) in their place and brings the records of one digest together; :func:`rollup` then counts narrow rows where they are and
    gives each group its dimensions back from one row per digest. So each record is shuffled once instead of each slice, and no
    aggregate holds wide rows. The records are read twice; a digest that the second reading lacks is an error. For batch and
    ``mode="exact"``, and for dimensions that tell records apart: equal ones meet in one task, uncombined.
    """

    def __init__(self, spec: RollupSpec):
        if spec.dims is None:
            raise ValueError("a schemaless rollup has no fixed dimensions to keep apart")
        self.spec, self.dims, self.rows = spec, [], None

    def take(self, df: DataFrame) -> DataFrame:
        """``df`` with the digest ``_dims`` for its dimensions; those that a metric reads as a value stay as well."""
        self.dims = [d for d in dims_of(df, self.spec) if d not in CHANGED and df.schema[d].dataType in _TEXTUAL]
        if not self.dims:
            return df
        read = {source for kind, source in self.spec.aggs.values() if kind != "distinct"}
        text = F.array(*[F.col(d).cast("string") for d in self.dims])
        # with the lengths in front, no two rows of values run together to the same text; a lambda keeps this out of one huge generated method
        lengths = F.transform(text, F.octet_length).cast("string")
        digest = F.unhex(F.substring(F.sha2(F.concat_ws("", lengths, text), 256), 1, 32))
        df = df.withColumn("_dims", F.coalesce(digest, F.lit(b"")))
        # any_value of a row sorts by digest, which the join needs as well
        self.rows = df.select("_dims", F.struct(*self.dims).alias("_row")).repartition("_dims").groupBy("_dims").agg(F.any_value("_row").alias("_row"))
        return df.drop(*[d for d in self.dims if d not in read]).repartition("_dims")

    def put_back(self, grouped: DataFrame) -> DataFrame:
        """``grouped`` with the dimensions for their digest."""
        lost = F.raise_error(F.lit("the records have other dimensions than when they were read first"))
        found = grouped.join(self.rows, "_dims", "left").withColumn("_row", F.coalesce("_row", lost))
        return found.select(*[c for c in grouped.columns if c != "_dims"], *[F.col("_row")[d].alias(d) for d in self.dims])


def rollup(df: DataFrame, spec: RollupSpec, mode: str = "approx", now: Column | None = None,
           extra_dims: tuple[str, ...] = (), watermark: bool = False, complete: bool = False, apart: Apart | None = None) -> DataFrame:
    """One row per minute and dimension values.

    With ``complete`` the output has every dimension of the specification, NULL text where the input lacks it, so a
    datasource's schema does not depend on its input.

    ``mode`` picks how distinct counts are kept: ``approx`` gives numbers, ``sketch`` gives mergeable
    HLL sketches (see :func:`merge_rollups`), ``exact`` counts exactly. With ``watermark`` the spec's
    late limit applies, for streaming. Columns outside the spec never reach the shuffle; an ``extras``
    map of a schemaless rollup is grouped by its sorted JSON text. ``apart`` is what took the dimensions of ``df`` before its split.
    """
    if apart is not None and (mode != "exact" or df.isStreaming or apart.spec.dims != spec.dims):
        raise ValueError("dimensions are kept apart in exact batch rollups of their own specification only")
    held = apart.dims if apart is not None else []
    seconds = event_seconds(df, spec, now)
    if watermark:
        df = df.withColumn("event_time", F.timestamp_seconds(seconds)).withWatermark("event_time", spec.late)
        minute = F.window("event_time", GRANULARITY).alias("_minute")
        start = F.unix_timestamp(F.col("_minute.start"))
    else:
        minute = (seconds - F.pmod(seconds, F.lit(60))).alias("_minute")
        start = F.col("_minute")
    dims = [*extra_dims, *dims_of(df.drop(*extra_dims), spec)]
    if held:
        dims = [*extra_dims, *[d for d in spec.dims if d in {*df.columns, *held} and d not in extra_dims]]
    if spec.dims is None and "extras" in df.columns:
        df = df.withColumn("extras", F.to_json(F.array_sort(F.map_entries("extras"))))
        dims.append("extras")
    sets = _expanding(df, spec, dims)
    # a group has one value of a dimension that is apart, counted when it is back
    counted = {name: F.when(F.col(source).isNotNull(), 1).otherwise(0).cast("bigint") for name, (kind, source) in spec.aggs.items() if kind == "distinct" and source in held}
    aggs = {name: [] if name in counted else _aggregate(df, kind, source, name, mode, dims, sets) for name, (kind, source) in spec.aggs.items()}
    keys = [*[d for d in dims if d not in held], *(["_dims"] if held else [])]
    # records without a time fall in no minute
    grouped = df.groupBy(minute, *keys).agg(*[a for columns in aggs.values() for a in columns]).filter(F.col("_minute").isNotNull())
    if held:
        made = iter(grouped.columns[1 + len(keys):])
        metrics = [c for name, columns in aggs.items() for c in ([name] if name in counted else [next(made) for _ in columns])]
        grouped = apart.put_back(grouped).withColumns(counted).select("_minute", *dims, *metrics)
    if complete and spec.dims is not None:
        missing = set(absent_dims(df, spec)) - set(held)
        own = [F.lit(None).cast("string").alias(d) if d in missing else F.col(d).cast("string").alias(d) for d in spec.dims if d not in extra_dims]
        metrics = [c for c in grouped.columns if c not in {"_minute", *dims}]
        return grouped.select(start.alias("timestamp"), *extra_dims, *own, *metrics)
    rest = [c for c in grouped.columns if c != "_minute"]
    return grouped.select(start.alias("timestamp"), *rest)


def merge_rollups(parts: DataFrame, spec: RollupSpec, dims: list[str], every: str = "1 hour", keep_sketches: bool = False) -> DataFrame:
    """Coarser rollup from ``mode="sketch"`` rows, or with ``every="1 minute"`` one row for each minute that several batches wrote.

    Sums and histogram bins add up, extremes combine, sketches union; with ``keep_sketches`` the result can be merged again.
    """
    aggs: list[Column] = []
    for name, (kind, _) in spec.aggs.items():
        if kind in ("count", "lsum", "dsum"):
            aggs.append(F.sum(name).alias(name))
        elif kind in ("min", "max"):
            aggs.append(getattr(F, kind)(name).alias(name))
        elif kind == "distinct":
            union = F.hll_union_agg(name)
            aggs.append((union if keep_sketches else F.hll_sketch_estimate(union)).alias(name))
        else:
            aggs += [F.sum(f"{name}_{side}").alias(f"{name}_{side}") for side in ("below", "above")]
            aggs.append(F.array(*[F.sum(F.element_at(name, i + 1)) for i in range(HISTOGRAM_BINS)]).alias(name))
            if f"{name}_sketch" in parts.columns:
                aggs.append(F.kll_merge_agg_double(f"{name}_sketch").alias(f"{name}_sketch"))
    at = F.window(F.timestamp_seconds("timestamp"), every).alias("window")
    merged = parts.groupBy(at, *dims).agg(*aggs)
    rest = [c for c in merged.columns if c != "window"]
    return merged.select(F.unix_timestamp(F.col("window.start")).alias("timestamp"), *rest)


def quantiles(sketch: Column | str, shares: list[float]) -> Column:
    """Values at the given shares of what a histogram sketch has seen, NULL where it has seen nothing."""
    sketch = F.col(sketch) if isinstance(sketch, str) else sketch
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in shares]))


def buckets(sketch: Column | str, n: int = HISTOGRAM_BUCKETS) -> Column:
    """``n`` buckets of equal width between the histogram's bounds: array of (from, count), counts estimated from ranks."""
    sketch = F.col(sketch) if isinstance(sketch, str) else sketch
    seen = F.kll_sketch_get_n_double(sketch)
    edges = [HISTOGRAM_LOW + (HISTOGRAM_HIGH - HISTOGRAM_LOW) * i / n for i in range(n + 1)]
    ranks = [F.lit(0.0), *[F.kll_sketch_get_rank_double(sketch, F.lit(e)) for e in edges[1:-1]], F.lit(1.0)]
    return F.when(seen > 0, F.array(*[F.struct(F.lit(edges[i]).alias("from"), ((ranks[i + 1] - ranks[i]) * seen).alias("count")) for i in range(n)]))
