"""Spark jobs for monthly job-posting threads: ingest, extract, normalize, report, evaluate."""
