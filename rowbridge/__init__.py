"""Batch extraction, row transformation, merging and export as Spark jobs."""
