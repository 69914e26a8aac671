"""Batch lakehouse analytics on Spark: ingest, clean, model, measure, check.

Everything is a function from DataFrames to DataFrames.  Nothing here collects
rows to the driver; the few driver-side reads are bounded metadata (bucket cut
points, pivot headers, load manifests) and say so where they happen.
"""
