"""Readers, sinks and report paths."""
