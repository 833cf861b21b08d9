"""Tiled geospatial data, incident timelines and corpus preparation as Spark DataFrame operators."""
