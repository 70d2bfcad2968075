"""Warehouse data jobs for a partner-facing sign-in service, on Spark DataFrames.

functions   column expressions (JSON paths, dates, text, arrays)
sources     readers, sinks and report paths
operators   DataFrame -> DataFrame jobs (dedup, upsert, checks, masking, ...)
plans       reports composed from the operators
streaming   Structured Streaming forms of the polling jobs
bindings    the operators bound to the sample tables, with their SQL oracle
"""
