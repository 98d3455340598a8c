"""Topic pipelines and datasource routing."""
