"""Scans and sinks (parquet, CSV, GeoJSON) and the raw tables derived from the driver data."""
