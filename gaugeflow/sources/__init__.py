"""Scans: message streams, delimited text, snapshots, GeoJSON, the catalog."""
