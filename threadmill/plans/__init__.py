"""Whole jobs: ingest, stats, extract, normalize, report, golden set, datasets."""
