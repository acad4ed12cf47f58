"""Incremental link extraction over versioned text corpora, on Spark DataFrames."""
