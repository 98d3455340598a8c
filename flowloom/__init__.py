"""flowloom: network-telemetry enrichment and minute rollups as Spark DataFrame operators."""

__version__ = "0.1.0"
