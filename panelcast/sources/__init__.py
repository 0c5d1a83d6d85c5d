"""Scans and sinks: landed files, the feature table, snapshots, published results, models."""
