"""The whole flow path: client state, places, enrichers, split, minute rollup."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import lookup, privacy, ranges, records, rollup
from flowloom.operators.counters import datasource_name
from flowloom.operators.lookup import StoreSpec
from workload.catalog import query
from workload.clients import SEEN, places, with_client_states
from workload.scalar import SLICES, SRC_PLAIN, VENDORS, geo_body, salts, vendors
from workload.views import oracle, view

PATH = replace(rollup.FLOW, dims=(
    "application_id_name", "client_mac_vendor", "ip_country_code", "ip_as_name", "building", "dot11_status"))


@query("flow_pipeline", oracle(f"""
select st - st % 60 as "timestamp", case when s.namespace_uuid is null then 'rb_flow' else 'rb_flow_' || s.namespace_uuid end as datasource, s.application_id_name,
  v.vendor as client_mac_vendor, g.ip_country_code, g.ip_as_name, p.building, case when coalesce(c.measure_id, c.info_id) is not null then 'ASSOCIATED' end as dot11_status,
  count(*) as events, cast(sum(s.bytes) as bigint) as sum_bytes, cast(sum(s.pkts) as bigint) as sum_pkts, cast(coalesce(sum(c.client_rssi_num), 0) as bigint) as sum_rssi,
  count(distinct s.client_mac) as clients, count(distinct coalesce(c.i_station, c.m_station)) as wireless_stations
from slices s join seen c on c.event_id = s.event_id left join places p on p.wireless_station = coalesce(c.i_station, c.m_station)
join geo g on g.event_id = s.event_id left join ({VENDORS}) v on v.oui = upper(left(replace(replace(s.client_mac, '-', ''), ':', ''), 6)) group by all""",
    SRC_PLAIN + "," + SLICES + "," + SEEN + f""",
 geo as ({geo_body("coalesce(wan_cc, lan_cc) as ip_country_code, coalesce(wan_as, lan_as) as ip_as_name")})"""))
def flow_pipeline(spark: SparkSession, sf: str, mode: str = "exact") -> DataFrame:
    raw = view(spark, sf, "fx_flow")
    flows = with_client_states(spark, sf, raw)
    geo = view(spark, sf, "fx_geo")
    out = records.flow(
        flows,
        [StoreSpec("places", places(spark), keys=("wireless_station",), overwrite=False)],
        [lookup.vendor_enricher(vendors(spark)), ranges.geo_enricher(geo, geo, addresses_of=raw, row_id="event_id"), privacy.mac_enricher(salts(spark))],
        now="arrival")
    out = out.withColumn("datasource", datasource_name("rb_flow", F.col("namespace_uuid")))
    return rollup.rollup(out, PATH, mode=mode, extra_dims=("datasource",))


@query("flow_pipeline_approx")
def flow_pipeline_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The same path with distinct counts estimated, as the rollups are meant to run."""
    return flow_pipeline(spark, sf, "approx")
